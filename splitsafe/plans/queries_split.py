"""Registered split / sampling queries (F1-F8, K1, K4) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import round6
from ..operators import split as S
from ..sources.tables import SQL_VIEWS, table, view
from .registry import register
from .sqlgen import sql_hash_int, sql_round6

H_ORDER = sql_hash_int(42, "o_orderkey")
H_CUST = sql_hash_int(42, "o_custkey")

# exact stratified split of orders_y in SQL: allocation by largest remainder, then
# the first t_c rows per class in (h, key) order are test
STRAT_CTE = f"""
WITH y AS ({SQL_VIEWS['orders_y']}),
c AS (SELECT target, count(*) AS cnt FROM y WHERE target IS NOT NULL GROUP BY target),
t AS (SELECT sum(cnt) AS n, CAST(ceil(0.2::DOUBLE * sum(cnt)) AS BIGINT) AS n_test FROM c),
a AS (SELECT c.target, c.cnt, (c.cnt * (t.n - t.n_test)) / t.n::DOUBLE AS cont,
             floor((c.cnt * (t.n - t.n_test)) / t.n::DOUBLE) AS fl, t.n - t.n_test AS n_train FROM c, t),
b AS (SELECT *, row_number() OVER (ORDER BY cont - fl DESC, cnt, CAST(target AS VARCHAR)) AS rk,
             n_train - sum(fl) OVER () AS extra FROM a),
alloc AS (SELECT target, cnt - (fl + CASE WHEN rk <= extra THEN 1 ELSE 0 END) AS n_test_c FROM b),
r AS (SELECT y.*, row_number() OVER (PARTITION BY target ORDER BY {H_ORDER}, o_orderkey) AS rn FROM y),
s AS (SELECT r.*, CASE WHEN r.target IS NULL THEN NULL WHEN rn <= n_test_c THEN 'test' ELSE 'train' END AS split
      FROM r LEFT JOIN alloc USING (target))
"""


def _strat(spark, sf_dir):
    df, roles = view(spark, sf_dir, "orders_y")
    return S.stratified_split(df, "target", "o_orderkey", 0.2, 42), roles


@register("stratified_exact", STRAT_CTE + "SELECT o_orderkey, target, split FROM s")
def stratified_exact(spark, sf_dir):
    return _strat(spark, sf_dir)[0].select("o_orderkey", "target", "split")


@register("split_stats", STRAT_CTE + f"""
, p AS (SELECT split, count(*) AS n, avg(CAST(target AS DOUBLE)) AS target_rate FROM s GROUP BY split)
SELECT split, n, {sql_round6('n / (SELECT sum(n) FROM p)::DOUBLE')} AS share, {sql_round6('target_rate')} AS target_rate,
       abs((SELECT target_rate FROM p WHERE split = 'train') - (SELECT target_rate FROM p WHERE split = 'test')) * 100 < 0.5
         AS balanced
FROM p""")
def split_stats(spark, sf_dir):
    st = S.split_stats(_strat(spark, sf_dir)[0], "target")
    return st.select("split", "n", round6("share").alias("share"), round6("target_rate").alias("target_rate"),
                     "balanced")


@register("group_overlap", STRAT_CTE + """
, g AS (SELECT o_custkey, max(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS tr,
               max(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS te FROM s WHERE o_custkey IS NOT NULL GROUP BY o_custkey)
SELECT CAST(sum(tr * te) AS BIGINT) AS n_both, CAST(sum(tr) AS BIGINT) AS n_train_groups,
       CAST(sum(te) AS BIGINT) AS n_test_groups, count(*) AS n_groups FROM g""")
def group_overlap(spark, sf_dir):
    return S.group_overlap(_strat(spark, sf_dir)[0], "o_custkey")


@register("hash_split_overlap", f"""
WITH s AS (SELECT o_custkey, CASE WHEN {H_ORDER} % 10 < 2 THEN 'test' ELSE 'train' END AS split FROM orders),
g AS (SELECT o_custkey, max(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS tr,
             max(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS te FROM s GROUP BY o_custkey)
SELECT CAST(sum(tr * te) AS BIGINT) AS n_both, CAST(sum(tr) AS BIGINT) AS n_train_groups,
       CAST(sum(te) AS BIGINT) AS n_test_groups, count(*) AS n_groups FROM g""")
def hash_split_overlap(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return S.group_overlap(S.hash_split(df, "o_orderkey", 0.2, 42), "o_custkey")


@register("group_folds", f"SELECT o_orderkey, o_custkey, CAST({H_CUST} % 5 AS INTEGER) AS fold FROM orders")
def group_folds(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return S.group_kfold(df, "o_custkey", 5, 42).select("o_orderkey", "o_custkey", "fold")


@register("fold_overlap", f"""
WITH y AS ({SQL_VIEWS['orders_y']}),
f AS (SELECT *, CAST({H_CUST} % 5 AS INTEGER) AS fold FROM y),
pg AS (SELECT o_custkey FROM f GROUP BY o_custkey HAVING min(fold) <> max(fold)),
sh AS (SELECT fold, count(DISTINCT o_custkey) AS n_shared FROM f WHERE o_custkey IN (SELECT o_custkey FROM pg) GROUP BY fold)
SELECT fold, count(*) AS n, CAST(sum(target) AS BIGINT) AS n_pos, count(DISTINCT f.o_custkey) AS n_groups,
       CAST(coalesce(max(sh.n_shared), 0) AS BIGINT) AS overlap
FROM f LEFT JOIN sh USING (fold) GROUP BY fold""")
def fold_overlap(spark, sf_dir):
    df, _ = view(spark, sf_dir, "orders_y")
    return S.fold_overlap(S.group_kfold(df, "o_custkey", 5, 42), "o_custkey", "target")


_BAL_G = f"(('0x' || substr(md5('42:' || CAST(o_custkey AS VARCHAR)), 1, 8))::BIGINT)"


@register("balanced_folds", f"""
WITH g AS (SELECT o_custkey, count(*) AS size, {_BAL_G} AS h FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey),
d AS (SELECT o_custkey, size, h, h % 64 AS bkt,
             row_number() OVER (PARTITION BY size, h % 64 ORDER BY h, o_custkey) AS rn FROM g),
f AS (SELECT o_custkey, CAST((rn - 1 + {sql_hash_int(42, 'size', 'bkt')} % 5) % 5 AS INTEGER) AS fold FROM d)
SELECT fold, count(*) AS n, count(DISTINCT o_custkey) AS n_groups FROM orders JOIN f USING (o_custkey) GROUP BY fold""")
def balanced_folds(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    f = S.group_kfold(df, "o_custkey", 5, 42, balanced=True, n_buckets=64)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("n_groups"))


@register("temporal_split", """
WITH n AS (SELECT CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT) AS n_train FROM orders),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, CASE WHEN rn <= (SELECT n_train FROM n) THEN 'train' ELSE 'test' END AS split FROM r""")
def temporal_split(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return S.temporal_split(df, ["o_orderdate", "o_orderkey"], 0.8).select("o_orderkey", "split")


@register("temporal_split_bigkey", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN rn <= CAST(floor(n * 0.8::DOUBLE) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM r""")
def temporal_split_bigkey(spark, sf_dir):
    """Ordered by a 64-bit key that a double can't hold."""
    df = table(spark, sf_dir, "orders").withColumn("big", F.col("o_orderkey").cast("long") + (1 << 60))
    return S.temporal_split(df, ["big"], 0.8).select("o_orderkey", "split")


@register("temporal_split_nulls", """
WITH k AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS d FROM orders),
r AS (SELECT *, row_number() OVER (ORDER BY d NULLS LAST, o_orderkey) AS rn, count(d) OVER () AS n FROM k)
SELECT o_orderkey, CASE WHEN d IS NOT NULL THEN CASE WHEN rn <= CAST(floor(n * 0.8::DOUBLE) AS BIGINT) THEN 'train' ELSE 'test' END END AS split
FROM r""")
def temporal_split_nulls(spark, sf_dir):
    """A third of the orders have no order value: they get no split."""
    df = table(spark, sf_dir, "orders").withColumn("d", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")))
    return S.temporal_split(df, ["d", "o_orderkey"], 0.8).select("o_orderkey", "split")


@register("sample_rows", f"""
WITH n AS (SELECT CAST(floor(count(*) * 0.3::DOUBLE) AS BIGINT) AS k FROM orders),
r AS (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY {H_ORDER}, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, o_custkey FROM r WHERE rn <= (SELECT k FROM n)""")
def sample_rows(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return S.sample_rows(df, "o_orderkey", frac=0.3, seed=42).select("o_orderkey", "o_custkey")


@register("compare_splits", STRAT_CTE + f""",
g AS (SELECT *, CASE WHEN {H_CUST} % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM y),
both_ AS (SELECT 'random_stratified' AS scheme, o_custkey, target, split FROM s
          UNION ALL SELECT 'group_kfold', o_custkey, target, split FROM g),
st AS (SELECT scheme, count(*) FILTER (WHERE split = 'test') AS n_test, count(*) AS n,
              avg(CAST(target AS DOUBLE)) FILTER (WHERE split = 'train') AS train_rate,
              avg(CAST(target AS DOUBLE)) FILTER (WHERE split = 'test') AS test_rate FROM both_ GROUP BY scheme),
pg AS (SELECT scheme, o_custkey, max(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS tr,
              max(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS te FROM both_ WHERE o_custkey IS NOT NULL
       GROUP BY scheme, o_custkey),
ov AS (SELECT scheme, CAST(sum(tr * te) AS BIGINT) AS n_both FROM pg GROUP BY scheme)
SELECT scheme, n_test, {sql_round6('n_test / n::DOUBLE')} AS test_share, {sql_round6('train_rate')} AS train_rate,
       {sql_round6('test_rate')} AS test_rate, n_both FROM st JOIN ov USING (scheme)""")
def compare_splits(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    c = S.compare_splits(df, "target", "o_orderkey", "o_custkey")
    return c.select("scheme", "n_test", *[round6(x).alias(x) for x in ("test_share", "train_rate", "test_rate")],
                    "n_both")


@register("preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(spark, sf_dir):
    """A4: first rows in an explicit order (the limit is the feature)."""
    from ..sources.csv import preview as pv
    return pv(table(spark, sf_dir, "orders"), "o_orderkey", 5)


# ------------------------------------------------------------------ order by text and by long decimals

TEXT_TIME = "strftime(o_orderdate, '%Y/%m/%d') || CASE WHEN o_orderkey % 3 = 0 THEN ' é' ELSE '' END"
BIG_DECIMAL = ("CAST(CAST(o_orderkey % 97 - 48 AS STRING) || '00000000000000000000.0000' || "
               "lpad(CAST(o_orderkey AS STRING), 6, '0') AS DECIMAL(38,10))")


def _first_80(order: str) -> str:
    return f"""WITH o AS (SELECT *, row_number() OVER (ORDER BY {order}) AS rn FROM orders)
SELECT o_orderkey, CASE WHEN rn <= (SELECT CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT) FROM orders) THEN 'train' ELSE 'test' END AS split FROM o"""


@register("temporal_split_text", _first_80(f"{TEXT_TIME}, 'key ' || CAST(o_orderkey AS VARCHAR)"))
def temporal_split_text(spark, sf_dir):
    """A date kept as text, ties broken by a text key."""
    df = table(spark, sf_dir, "orders").withColumn(
        "t", F.expr(TEXT_TIME.replace("strftime", "date_format").replace("%Y/%m/%d", "yyyy/MM/dd")))
    df = df.withColumn("k", F.concat(F.lit("key "), F.col("o_orderkey").cast("string")))
    return S.temporal_split(df, ["t", "k"], 0.8).select("o_orderkey", "split")


@register("temporal_split_decimal", _first_80(BIG_DECIMAL.replace("STRING", "VARCHAR")))
def temporal_split_decimal(spark, sf_dir):
    """Positive and negative decimals of 32 digits that differ behind the point only."""
    df = table(spark, sf_dir, "orders").withColumn("d", F.expr(BIG_DECIMAL))
    return S.temporal_split(df, ["d"], 0.8).select("o_orderkey", "split")


# ------------------------------------------------------------------ largest-first folds

_LOADS = [f"l{i}" for i in range(5)]
_LEAST = f"least({', '.join(_LOADS)})"


@register("balanced_folds_greedy", """WITH RECURSIVE g AS (SELECT size, row_number() OVER (ORDER BY size DESC, user_id) AS step
  FROM (SELECT user_id, count(*) AS size FROM events WHERE user_id IS NOT NULL GROUP BY user_id)),
s AS (SELECT CAST(0 AS BIGINT) AS step, """ + ", ".join(f"CAST(0 AS BIGINT) AS {x}" for x in _LOADS) + """
  UNION ALL SELECT g.step, """ + ", ".join(
    f"{x} + CASE WHEN {x} = {_LEAST}" + "".join(f" AND {y} > {_LEAST}" for y in _LOADS[:i]) + " THEN g.size ELSE 0 END"
    for i, x in enumerate(_LOADS)) + """ FROM s JOIN g ON g.step = s.step + 1),
e AS (SELECT * FROM s ORDER BY step DESC LIMIT 1) """ + " UNION ALL ".join(
    f"SELECT {i} AS fold, {x} AS n FROM e" for i, x in enumerate(_LOADS)))
def balanced_folds_greedy(spark, sf_dir):
    """Rows of each fold; the oracle deals the groups one by one."""
    df = table(spark, sf_dir, "events").where(F.col("user_id").isNotNull())
    return S.group_kfold(df, "user_id", 5, balanced="largest_first").groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
