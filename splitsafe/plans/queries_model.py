"""Registered encoding / fit / AUC / injection / experiment queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round6
from ..operators import chartdata, clean, complement, encode, experiments as X, fit, inject, metrics, model, split
from ..sources.tables import SQL_VIEWS, table, view
from .registry import register
from .sqlmodel import logit_auc, logit_ctes
from .sqlgen import (auc_cte, auc_guide, auc_interpretation, gauge_severity, inflation_severity, memorise_cte,
                     sql_gaussian, sql_hash_int, sql_round6 as r6, strat_ctes)


def W(*names):
    return "WITH " + ", ".join(f"{n} AS ({SQL_VIEWS[n]})" for n in names) + ", "


def _r6(df, *cols):
    return df.select(*[round6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ target encoding

@register("target_encode_leaky", W("orders_y") + """
e AS (SELECT o_custkey, avg(CAST(target AS DOUBLE)) AS encoded FROM orders_y WHERE o_custkey IS NOT NULL GROUP BY o_custkey)
SELECT o_orderkey, """ + r6("e.encoded") + """ AS encoded FROM orders_y LEFT JOIN e USING (o_custkey)""")
def target_encode_leaky(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    out = encode.target_encode(df, "o_custkey", r.target, None, fallback=None)
    return _r6(out.select("o_orderkey", "encoded"), "encoded")


@register("target_encode_honest", W("orders_y") + strat_ctes("orders_y", "o_orderkey", "st") + """,
e AS (SELECT o_custkey, avg(CAST(target AS DOUBLE)) AS encoded FROM st_s WHERE split = 'train' AND o_custkey IS NOT NULL
      GROUP BY o_custkey),
m AS (SELECT avg(CAST(target AS DOUBLE)) AS m FROM st_s WHERE split = 'train')
SELECT o_orderkey, split, """ + r6("coalesce(e.encoded, (SELECT m FROM m))") + """ AS encoded
FROM st_s LEFT JOIN e USING (o_custkey)""")
def target_encode_honest(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    s = split.stratified_split(df, r.target, r.row_key, 0.2, 42)
    out = encode.target_encode(s, "o_custkey", r.target, F.col("split") == "train", fallback="mean")
    return _r6(out.select("o_orderkey", "split", "encoded"), "encoded")


_OOF_ENC = ("coalesce(CASE WHEN split = 'train' "
            "THEN (s - coalesce(sf, 0.0)) / NULLIF(CAST(n - coalesce(nf, 0) AS DOUBLE), 0) "
            "ELSE s / CAST(n AS DOUBLE) END, (SELECT m FROM m))")


@register("target_encode_oof", W("orders_y") + strat_ctes("orders_y", "o_orderkey", "st") + f""",
f AS (SELECT *, CASE WHEN split = 'train' THEN {sql_hash_int(42, 'o_orderkey')} % 5 END AS fold FROM st_s),
pc AS (SELECT o_custkey, sum(CAST(target AS DOUBLE)) AS s, count(target) AS n FROM f
       WHERE split = 'train' AND o_custkey IS NOT NULL GROUP BY o_custkey),
pf AS (SELECT o_custkey, fold, sum(CAST(target AS DOUBLE)) AS sf, count(target) AS nf FROM f
       WHERE split = 'train' AND o_custkey IS NOT NULL GROUP BY o_custkey, fold),
m AS (SELECT avg(CAST(target AS DOUBLE)) AS m FROM f WHERE split = 'train')
SELECT o_orderkey, split, {r6(_OOF_ENC)} AS encoded
FROM f LEFT JOIN pc USING (o_custkey) LEFT JOIN pf USING (o_custkey, fold)""")
def target_encode_oof(spark, sf_dir):
    """Out-of-fold encoding: no training row's own label enters its feature (Q16)."""
    df, r = view(spark, sf_dir, "orders_y")
    s = split.stratified_split(df, r.target, r.row_key, 0.2, 42)
    out = encode.target_encode_oof(s, "o_custkey", r.target, r.row_key, k=5, seed=42)
    return _r6(out.select("o_orderkey", "split", "encoded"), "encoded")


# ------------------------------------------------------------------ fit tables

FIT_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _fit_sql(src, feats, where="TRUE"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) AS n, count(*) - count({c}) AS n_null, {r6(f'median({c})')} AS median, "
        f"{r6(f'avg(coalesce({c}, (SELECT median({c}) FROM {src} WHERE {where})))')} AS mean, "
        f"{r6(f'stddev_pop(coalesce({c}, (SELECT median({c}) FROM {src} WHERE {where})))')} AS std_pop "
        f"FROM {src} WHERE {where}" for c in feats)


@register("fit_stats", W("line_nulls") + "x AS (SELECT 1) " + _fit_sql("line_nulls", FIT_FEATURES))
def fit_stats(spark, sf_dir):
    df, _ = view(spark, sf_dir, "line_nulls")
    return _r6(fit.fit_stats(df, FIT_FEATURES), "median", "mean", "std_pop")


def _fold_fit_sql(c):
    """The statistics of the rows outside each fold, every fold fitted by itself."""
    return (f"SELECT CAST(g.fold AS INTEGER) AS fold, '{c}' AS feature, count(*) AS n, count(*) - count({c}) AS n_null, "
            f"{r6('max(m.md)')} AS median, {r6(f'avg(coalesce({c}, m.md))')} AS mean, {r6(f'stddev_pop(coalesce({c}, m.md))')} AS std_pop "
            f"FROM range(5) g(fold) JOIN x ON x.fold <> g.fold "
            f"JOIN (SELECT h.fold, median({c}) AS md FROM range(5) h(fold) JOIN x ON x.fold <> h.fold GROUP BY h.fold) m ON m.fold = g.fold "
            f"GROUP BY g.fold")


@register("fold_fit_stats", W("line_nulls") + f"x AS (SELECT *, {sql_hash_int(42, 'l_orderkey')} % 5 AS fold FROM line_nulls) "
          + " UNION ALL ".join(_fold_fit_sql(c) for c in FIT_FEATURES))
def fold_fit_stats(spark, sf_dir):
    """The fits of all five training complements of a group k-fold, from one pass."""
    df, _ = view(spark, sf_dir, "line_nulls")
    folds = split.group_kfold(df, "l_orderkey", 5, 42)
    return _r6(complement.fold_fit_stats(folds, FIT_FEATURES, "fold"), "median", "mean", "std_pop")


TEMP_CTE = """
tn AS (SELECT CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT) AS n_train FROM orders),
ts AS (SELECT o.*, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= (SELECT n_train FROM tn)
                   THEN 'train' ELSE 'test' END AS split FROM orders o)"""
SCALE_FEATURES = ["o_totalprice", "o_custkey"]


@register("scaled", "WITH " + TEMP_CTE + ", " + ", ".join(
    f"f_{c} AS (SELECT median({c}) AS md, avg(CAST({c} AS DOUBLE)) AS mu, stddev_pop(CAST({c} AS DOUBLE)) AS sd "
    f"FROM ts WHERE split = 'train')" for c in SCALE_FEATURES) + " SELECT o_orderkey, split, " + ", ".join(
    r6(f"(coalesce(CAST({c} AS DOUBLE), (SELECT md FROM f_{c})) - (SELECT mu FROM f_{c})) / "
       f"(SELECT CASE WHEN sd > 0 THEN sd ELSE 1.0 END FROM f_{c})") + f" AS {c}" for c in SCALE_FEATURES)
    + " FROM ts")
def scaled(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    s = split.temporal_split(df, ["o_orderdate", "o_orderkey"], 0.8)
    f = fit.fit_stats(s, SCALE_FEATURES, F.col("split") == "train")
    return _r6(fit.apply_fit(s, f, SCALE_FEATURES, keep=["o_orderkey", "split"]), *SCALE_FEATURES)


@register("fit_drift", "WITH " + TEMP_CTE + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature,
        {r6(f"median({c}) FILTER (WHERE split = 'train')")} AS median_train,
        {r6(f"avg(CAST({c} AS DOUBLE)) FILTER (WHERE split = 'train')")} AS mean_train,
        {r6(f"stddev_pop(CAST({c} AS DOUBLE)) FILTER (WHERE split = 'train')")} AS std_pop_train,
        {r6(f"median({c})")} AS median_all, {r6(f"avg(CAST({c} AS DOUBLE))")} AS mean_all,
        {r6(f"stddev_pop(CAST({c} AS DOUBLE))")} AS std_pop_all,
        {r6(f"(avg(CAST({c} AS DOUBLE)) - avg(CAST({c} AS DOUBLE)) FILTER (WHERE split = 'train')) / stddev_pop(CAST({c} AS DOUBLE)) FILTER (WHERE split = 'train')")} AS mean_shift_sd,
        {r6(f"stddev_pop(CAST({c} AS DOUBLE)) / stddev_pop(CAST({c} AS DOUBLE)) FILTER (WHERE split = 'train')")} AS std_ratio
    FROM ts""" for c in SCALE_FEATURES))
def fit_drift(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    d = X.scaling_fit_drift(df, SCALE_FEATURES, ["o_orderdate", "o_orderkey"], 0.8)
    cols = ["median_train", "mean_train", "std_pop_train", "median_all", "mean_all", "std_pop_all",
            "mean_shift_sd", "std_ratio"]
    return _r6(d.select("feature", *cols), *cols)


# ------------------------------------------------------------------ AUC

@register("roc_auc", W("orders_y") + auc_cte("a", "orders_y", "o_totalprice") + """,
n AS (SELECT CAST(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
             CAST(sum(CASE WHEN target = 1 THEN 0 ELSE 1 END) AS BIGINT) AS n_neg FROM orders_y)
SELECT """ + r6("(SELECT auc FROM a)") + " AS auc, n_pos, n_neg FROM n")
def roc_auc(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    return _r6(metrics.roc_auc(df, "o_totalprice", r.target), "auc")


@register("feature_auc", W("orders_post") + auc_cte("a1", "orders_post", "o_totalprice") + ", "
          + auc_cte("a2", "orders_post", "o_custkey") + """
SELECT 'o_totalprice' AS feature, """ + r6("(SELECT auc FROM a1)") + """ AS auc
UNION ALL SELECT 'o_custkey', """ + r6("(SELECT auc FROM a2)"))
def feature_auc(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_post")
    long = df.select(r.target, *[F.col(c).cast("double").alias(c) for c in ("o_totalprice", "o_custkey")]) \
             .unpivot([r.target], ["o_totalprice", "o_custkey"], "feature", "x")
    return _r6(metrics.roc_auc(long, "x", r.target, by=["feature"]).select("feature", "auc"), "auc")


@register("roc_points", W("orders_post") + """
s AS (SELECT CAST(o_totalprice AS DOUBLE) AS sc, CAST(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
             CAST(sum(CASE WHEN target = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM orders_post
      WHERE o_totalprice IS NOT NULL GROUP BY 1),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM s),
c AS (SELECT sum(pos) OVER (ORDER BY sc DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             sum(neg) OVER (ORDER BY sc DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM s),
b AS (SELECT CAST((fp * 20 + (SELECT N FROM tot) - 1) // (SELECT N FROM tot) AS INTEGER) AS g,
             max(tp / (SELECT P FROM tot)::DOUBLE) AS tpr FROM c GROUP BY 1),
grid AS (SELECT CAST(range AS INTEGER) AS g FROM range(21))
SELECT """ + r6("grid.g / 20.0") + " AS fpr, " + r6(
    "coalesce(max(b.tpr) OVER (ORDER BY grid.g ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0)") + """ AS tpr
FROM grid LEFT JOIN b USING (g)""")
def roc_points(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_post")
    return _r6(metrics.roc_points(df, "o_totalprice", r.target, 20), "fpr", "tpr")


# ------------------------------------------------------------------ injectors

SAMPLE8 = f"""
n8 AS (SELECT CAST(floor(count(*) * 0.08::DOUBLE) AS BIGINT) AS k FROM orders_y),
pick AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {sql_hash_int(42, 'o_orderkey')}, o_orderkey) AS __rn
         FROM orders_y) WHERE __rn <= (SELECT k FROM n8)),
inj AS (SELECT *, 0 AS copy_no FROM orders_y UNION ALL SELECT * EXCLUDE (__rn), 1 FROM pick)"""


@register("inject_dups", W("orders_y") + SAMPLE8 + """
SELECT o_orderkey, copy_no, target FROM inj""")
def inject_dups(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    return inject.inject_duplicates(df, r.row_key, 0.08, 42).select("o_orderkey", "copy_no", "target")


@register("copy_counts", W("orders_y") + SAMPLE8 + " SELECT copy_no, count(*) AS n FROM inj GROUP BY copy_no")
def copy_counts(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    return chartdata.copy_counts(inject.inject_duplicates(df, r.row_key, 0.08, 42))


@register("inject_groups", W("orders_y") + f"""
g AS (SELECT DISTINCT o_custkey FROM orders_y WHERE o_custkey IS NOT NULL),
ng AS (SELECT CAST(floor(count(*) * 0.3::DOUBLE) AS BIGINT) AS k FROM g),
cg AS (SELECT o_custkey FROM (SELECT o_custkey, row_number() OVER (ORDER BY {sql_hash_int(42, 'o_custkey')}, o_custkey) AS rn
       FROM g) WHERE rn <= (SELECT k FROM ng))
SELECT o_orderkey, o_custkey, 0 AS copy_no, {r6('o_totalprice')} AS o_totalprice, target FROM orders_y
UNION ALL
SELECT o_orderkey, o_custkey, 1, {r6('o_totalprice + ' + sql_gaussian(42, 0.0, 0.05, 'o_orderkey', "'o_totalprice'"))},
       target FROM orders_y WHERE o_custkey IN (SELECT o_custkey FROM cg)""")
def inject_groups(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    out = inject.inject_group_overlap(df, r.group, r.row_key, ["o_totalprice"], 0.30, 0.05, 42)
    return _r6(out.select("o_orderkey", "o_custkey", "copy_no", "o_totalprice", "target"), "o_totalprice")


INJ_FEATURE = ("greatest(0.0, least(1.0, CASE WHEN target = 1 THEN " + sql_gaussian(42, 0.8, 0.15, "o_orderkey")
               + " ELSE " + sql_gaussian(42, 0.2, 0.15, "o_orderkey") + " END))")


@register("inject_feature", W("orders_y") + f"x AS (SELECT 1) SELECT o_orderkey, target, {r6(INJ_FEATURE)} AS "
          "SYNTHETIC_RISK_SCORE FROM orders_y")
def inject_feature(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    out = inject.inject_target_feature(df, r.target, r.row_key)
    return _r6(out.select("o_orderkey", "target", "SYNTHETIC_RISK_SCORE"), "SYNTHETIC_RISK_SCORE")


@register("dedup_effect", W("orders_y") + SAMPLE8 + """,
g AS (SELECT count(*) AS c, sum(copy_no) AS inj FROM inj GROUP BY o_custkey, o_totalprice, o_orderpriority, target)
SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(inj) AS BIGINT) AS n_injected, count(*) AS n_after_dedup,
       CAST(sum(c - 1) AS BIGINT) AS n_removed, CAST(sum(greatest(c - 1 - inj, 0)) AS BIGINT) AS n_removed_original
FROM g""")
def dedup_effect(spark, sf_dir):
    """Q4: injected copies vs rows removed by de-duplicating on features + target."""
    df, r = view(spark, sf_dir, "orders_y")
    inj = inject.inject_duplicates(df, r.row_key, 0.08, 42)
    return inject.dedup_effect(inj, ["o_custkey", "o_totalprice", "o_orderpriority"], r.target)


# ------------------------------------------------------------------ model-free experiments

def _leak1_sql():
    return (strat_ctes("orders_y", "o_orderkey", "l1") + ",\n"
            "l1_ea AS (SELECT o_custkey, avg(CAST(target AS DOUBLE)) AS e FROM l1_s WHERE o_custkey IS NOT NULL "
            "GROUP BY o_custkey),\n"
            "l1_lk AS (SELECT x.target, e.e AS score FROM l1_s x LEFT JOIN l1_ea e USING (o_custkey) "
            "WHERE x.split = 'test'),"
            + memorise_cte("l1_hn", "l1_s", ["o_custkey"]) + ","
            + auc_cte("l1_auc_h", "l1_hn") + "," + auc_cte("l1_auc_l", "l1_lk") + ",\n"
            "leak1 AS (SELECT 1 AS sin, 'Target Encoding' AS name, (SELECT auc FROM l1_auc_h) AS honest_auc, "
            "(SELECT auc FROM l1_auc_l) AS leaky_auc)")


def _leak2_sql():
    return (strat_ctes("orders_y", "o_orderkey", "l2") + ",\n"
            f"l2_x AS (SELECT *, {INJ_FEATURE} AS inj FROM l2_s),"
            + auc_cte("l2_auc_h", "(SELECT * FROM l2_x WHERE split = 'test')", "o_totalprice") + ","
            + auc_cte("l2_auc_l", "(SELECT * FROM l2_x WHERE split = 'test')", "inj") + ",\n"
            "leak2 AS (SELECT 2 AS sin, 'Feature From Target' AS name, (SELECT auc FROM l2_auc_h) AS honest_auc, "
            "(SELECT auc FROM l2_auc_l) AS leaky_auc)")


def _leak4_sql():
    return (strat_ctes("orders_y", "o_orderkey", "l4") + ",\n"
            f"l4_g AS (SELECT *, CASE WHEN {sql_hash_int(42, 'o_custkey')} % 5 = 0 THEN 'test' ELSE 'train' END "
            "AS split FROM orders_y),"
            + memorise_cte("l4_hn", "l4_g", ["o_custkey"]) + ","
            + memorise_cte("l4_lk", "l4_s", ["o_custkey"]) + ","
            + auc_cte("l4_auc_h", "l4_hn") + "," + auc_cte("l4_auc_l", "l4_lk") + ",\n"
            "leak4 AS (SELECT 4 AS sin, 'Group Overlap' AS name, (SELECT auc FROM l4_auc_h) AS honest_auc, "
            "(SELECT auc FROM l4_auc_l) AS leaky_auc)")


LEAK5_FEATURES = ["o_custkey", "o_totalprice", "o_orderpriority"]


def _leak5_sql():
    feats = ", ".join(LEAK5_FEATURES)
    return (SAMPLE8 + ",\n"
            "l5_inj AS (SELECT *, CAST(o_orderkey AS BIGINT) * 2 + copy_no AS rk FROM inj),"
            + strat_ctes("l5_inj", "rk", "l5k") + ",\n"
            f"l5_dd AS (SELECT {feats}, target, min(rk) AS rk FROM l5_inj GROUP BY {feats}, target),"
            + strat_ctes("l5_dd", "rk", "l5h") + ","
            + memorise_cte("l5_hn", "l5h_s", LEAK5_FEATURES) + ","
            + memorise_cte("l5_lk", "l5k_s", LEAK5_FEATURES) + ","
            + auc_cte("l5_auc_h", "l5_hn") + "," + auc_cte("l5_auc_l", "l5_lk") + ",\n"
            "leak5 AS (SELECT 5 AS sin, 'Duplicate ID' AS name, (SELECT auc FROM l5_auc_h) AS honest_auc, "
            "(SELECT auc FROM l5_auc_l) AS leaky_auc)")


def _leak_select(name):
    return (f" SELECT sin, name, {r6('honest_auc')} AS honest_auc, {r6('leaky_auc')} AS leaky_auc, "
            f"{r6('leaky_auc - honest_auc')} AS inflation, {inflation_severity('leaky_auc - honest_auc')} AS severity "
            f"FROM {name}")


def _leak_df(res):
    r = res.select("sin", "name", "honest_auc", "leaky_auc", "inflation",
                   X_severity(F.col("inflation")).alias("severity"))
    return _r6(r, "honest_auc", "leaky_auc", "inflation")


def X_severity(c):
    from ..functions.tiers import inflation_severity as sev
    return sev(c)


def _leak1(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    return X.leak1_target_encoding(df, r, "o_custkey")


def _leak2(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    return X.leak2_injected_feature(df, r, "o_totalprice")


def _leak4(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    return X.leak4_group_overlap(df, r)


def _leak5(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    return X.leak5_duplicates(df, r, LEAK5_FEATURES)


@register("leak1_auc", W("orders_y") + _leak1_sql() + _leak_select("leak1"))
def leak1_auc(spark, sf_dir):
    return _leak_df(_leak1(spark, sf_dir))


def _leak1_hash_sql():
    return (f"l1h_s AS (SELECT *, CASE WHEN {sql_hash_int(42, 'o_orderkey')} % 10 < 2 THEN 'test' ELSE 'train' END "
            "AS split FROM orders_y),\n"
            "l1h_ea AS (SELECT o_custkey, avg(CAST(target AS DOUBLE)) AS e FROM l1h_s WHERE o_custkey IS NOT NULL "
            "GROUP BY o_custkey),\n"
            "l1h_lk AS (SELECT x.target, e.e AS score FROM l1h_s x LEFT JOIN l1h_ea e USING (o_custkey) "
            "WHERE x.split = 'test'),"
            + memorise_cte("l1h_hn", "l1h_s", ["o_custkey"]) + ","
            + auc_cte("l1h_auc_h", "l1h_hn") + "," + auc_cte("l1h_auc_l", "l1h_lk") + ",\n"
            "leak1h AS (SELECT 1 AS sin, 'Target Encoding' AS name, (SELECT auc FROM l1h_auc_h) AS honest_auc, "
            "(SELECT auc FROM l1h_auc_l) AS leaky_auc)")


@register("leak1_auc_hash_split", W("orders_y") + _leak1_hash_sql() + _leak_select("leak1h"))
def leak1_auc_hash_split(spark, sf_dir):
    """Leak 1 on the one-pass hash split (reproduces the published fixture pin)."""
    df, r = view(spark, sf_dir, "orders_y")
    return _leak_df(X.leak1_target_encoding(df, r, "o_custkey", mode="hash"))


@register("leak2_auc", W("orders_y") + _leak2_sql() + _leak_select("leak2"))
def leak2_auc(spark, sf_dir):
    return _leak_df(_leak2(spark, sf_dir))


@register("leak4_auc", W("orders_y") + _leak4_sql() + _leak_select("leak4"))
def leak4_auc(spark, sf_dir):
    return _leak_df(_leak4(spark, sf_dir))


@register("leak5_auc", W("orders_y") + _leak5_sql() + _leak_select("leak5"))
def leak5_auc(spark, sf_dir):
    return _leak_df(_leak5(spark, sf_dir))


def _leak5_text_sql():
    feats = ", ".join(LEAK5_FEATURES)
    order = f"{sql_hash_int(42, 'tk')}, {sql_hash_int('42~', 'tk')}"
    return ("n8 AS (SELECT CAST(floor(count(*) * 0.08::DOUBLE) AS BIGINT) AS k FROM orders_y),\n"
            "tk AS (SELECT *, 'order ' || CAST(o_orderkey AS VARCHAR) AS tk FROM orders_y),\n"
            f"pick AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS rn FROM tk) WHERE rn <= (SELECT k FROM n8)),\n"
            f"l5_inj AS (SELECT {feats}, target, tk || '#0' AS rk FROM tk UNION ALL SELECT {feats}, target, tk || '#1' FROM pick),"
            + strat_ctes("l5_inj", "rk", "l5k") + ",\n"
            f"l5_dd AS (SELECT {feats}, target, min(rk) AS rk FROM l5_inj GROUP BY {feats}, target),"
            + strat_ctes("l5_dd", "rk", "l5h") + ","
            + memorise_cte("l5_hn", "l5h_s", LEAK5_FEATURES) + ","
            + memorise_cte("l5_lk", "l5k_s", LEAK5_FEATURES) + ","
            + auc_cte("l5_auc_h", "l5_hn") + "," + auc_cte("l5_auc_l", "l5_lk") + ",\n"
            "leak5t AS (SELECT 5 AS sin, 'Duplicate ID' AS name, (SELECT auc FROM l5_auc_h) AS honest_auc, "
            "(SELECT auc FROM l5_auc_l) AS leaky_auc)")


@register("leak5_auc_textkey", W("orders_y") + _leak5_text_sql() + _leak_select("leak5t"))
def leak5_auc_textkey(spark, sf_dir):
    """Leak 5 on a table whose row key is text."""
    df, r = view(spark, sf_dir, "orders_y")
    df = df.withColumn("tk", F.concat(F.lit("order "), F.col("o_orderkey").cast("string")))
    return _leak_df(X.leak5_duplicates(df, replace(r, row_key="tk"), LEAK5_FEATURES))


ALL_LEAKS_SQL = (W("orders_y") + _leak1_sql() + "," + _leak2_sql() + "," + _leak4_sql() + "," + _leak5_sql()
                 + ",\nres AS (SELECT * FROM leak1 UNION ALL SELECT * FROM leak2 UNION ALL SELECT * FROM leak4 "
                 "UNION ALL SELECT * FROM leak5)")


def _all_leaks(spark, sf_dir) -> DataFrame:
    """The four model-free experiments as concurrent jobs; four one-row results."""
    from ..operators.concurrent import run_concurrently
    parts = run_concurrently(*[(lambda f=f: f(spark, sf_dir).collect()) for f in (_leak1, _leak2, _leak4, _leak5)])
    schema = "sin int, name string, honest_auc double, leaky_auc double, inflation double"
    return spark.createDataFrame([r for p in parts for r in p], schema)


@register("experiment_table", ALL_LEAKS_SQL + f"""
SELECT sin, name, {r6('honest_auc')} AS honest_auc, {r6('leaky_auc')} AS leaky_auc,
       {r6('leaky_auc - honest_auc')} AS inflation, {inflation_severity('leaky_auc - honest_auc')} AS severity,
       {gauge_severity('leaky_auc - honest_auc')} AS gauge_severity,
       {auc_interpretation('leaky_auc')} AS leaky_reading, {auc_interpretation('honest_auc')} AS honest_reading,
       {auc_guide('leaky_auc')} AS leaky_guide,
       'In production, this model would UNDERPERFORM expectations by '
         || printf('%.1f', round_even((leaky_auc - honest_auc) * 100, 1)) || '%' AS shortfall
FROM res""")
def experiment_table(spark, sf_dir):
    t = chartdata.experiment_table(_all_leaks(spark, sf_dir))
    return _r6(t, "honest_auc", "leaky_auc", "inflation")


@register("worst_leak", ALL_LEAKS_SQL + f"""
SELECT sin, name, {r6('leaky_auc - honest_auc')} AS inflation FROM res
ORDER BY leaky_auc - honest_auc DESC, sin ASC LIMIT 1""")
def worst_leak(spark, sf_dir):
    return _r6(chartdata.worst_experiment(_all_leaks(spark, sf_dir)), "inflation")


@register("leak_feature_histogram", W("orders_y") + f"""
x AS (SELECT target, {INJ_FEATURE} AS SYNTHETIC_RISK_SCORE FROM orders_y),""" + """
rng AS (SELECT target, CASE WHEN min(SYNTHETIC_RISK_SCORE) = max(SYNTHETIC_RISK_SCORE) THEN min(SYNTHETIC_RISK_SCORE) - 0.5
               ELSE min(SYNTHETIC_RISK_SCORE) END AS lo,
               CASE WHEN min(SYNTHETIC_RISK_SCORE) = max(SYNTHETIC_RISK_SCORE) THEN max(SYNTHETIC_RISK_SCORE) + 0.5
               ELSE max(SYNTHETIC_RISK_SCORE) END AS hi, count(*) AS n FROM x GROUP BY target),
cnt AS (SELECT x.target, CAST(least(floor((x.SYNTHETIC_RISK_SCORE - r.lo) * 40 / (r.hi - r.lo)), 39) AS INTEGER) AS bin,
               count(*) AS c FROM x JOIN rng r USING (target) GROUP BY 1, 2),
grid AS (SELECT CAST(range AS INTEGER) AS bin FROM range(40))
SELECT 'SYNTHETIC_RISK_SCORE' AS feature, r.target, g.bin, CAST(coalesce(c.c, 0) AS BIGINT) AS count
FROM rng r CROSS JOIN grid g LEFT JOIN cnt c ON c.target = r.target AND c.bin = g.bin""")
def leak_feature_histogram(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    x = inject.inject_target_feature(df, r.target, r.row_key)
    h = chartdata.histogram(x, ["SYNTHETIC_RISK_SCORE"], r.target, 40, density=False)
    return h.select("feature", "target", "bin", "count")


# ------------------------------------------------------------------ cleaning

@register("clean_table", "SELECT DISTINCT doc_id, n_chars FROM documents")
def clean_table(spark, sf_dir):
    df, _ = view(spark, sf_dir, "doc_labels")
    out, _log = clean.clean(df, protect=("doc_id",))
    return out


@register("clean_log", W("doc_labels") + """x AS (SELECT 1)
SELECT 'drop_missing' AS step, 'quality' AS "column", """ + r6("(count(*) - count(quality)) / count(*)::DOUBLE") + """ AS value
FROM doc_labels
UNION ALL SELECT 'drop_missing', 'toxic', """ + r6("(count(*) - count(toxic)) / count(*)::DOUBLE") + """ FROM doc_labels
UNION ALL SELECT 'drop_non_numeric', 'text', NULL UNION ALL SELECT 'drop_non_numeric', 'lang', NULL
UNION ALL SELECT 'drop_non_numeric', 'source', NULL""")
def clean_log(spark, sf_dir):
    df, _ = view(spark, sf_dir, "doc_labels")
    _out, log = clean.clean(df, protect=("doc_id",))
    return _r6(log, "value")


_QUIRK_DEDUP = W("orders_quirks") + """d AS (SELECT DISTINCT id, DAYS_BIRTH, DAYS_EMPLOYED, prio, target FROM orders_quirks) """


@register("clean_quirks", _QUIRK_DEDUP + f"""
SELECT CAST(id AS BIGINT) AS id, abs(CAST(DAYS_BIRTH AS BIGINT)) AS DAYS_BIRTH,
       abs(CASE WHEN DAYS_EMPLOYED <> 365243 THEN CAST(DAYS_EMPLOYED AS BIGINT) END) AS DAYS_EMPLOYED,
       target, {r6('round(abs(DAYS_BIRTH) / 365.25::DOUBLE, 1)')} AS AGE_YEARS FROM d""")
def clean_quirks(spark, sf_dir):
    """Repeated rows, sentinel, day counts and derived age."""
    df, _ = view(spark, sf_dir, "orders_quirks")
    out, _log = clean.clean(df, protect=("id", "target"))
    return _r6(out.select(*[F.col(c).cast("bigint").alias(c) if c in ("id", "DAYS_BIRTH", "DAYS_EMPLOYED") else c
                            for c in out.columns]), "AGE_YEARS")


@register("clean_quirks_log", _QUIRK_DEDUP + f"""
SELECT 'drop_missing' AS step, 'sparse' AS "column", {r6('(count(*) - count(sparse)) / count(*)::DOUBLE')} AS value FROM orders_quirks
UNION ALL SELECT 'drop_duplicates', NULL, CAST((SELECT count(*) FROM orders_quirks) - count(*) AS DOUBLE) FROM d
UNION ALL SELECT 'sentinel', 'DAYS_EMPLOYED', CAST(count(*) AS DOUBLE) FROM d WHERE DAYS_EMPLOYED = 365243
UNION ALL SELECT 'drop_non_numeric', 'prio', NULL""")
def clean_quirks_log(spark, sf_dir):
    df, _ = view(spark, sf_dir, "orders_quirks")
    return _r6(clean.clean(df, protect=("id", "target"))[1], "value")


@register("drop_null_rows", W("line_nulls") + """x AS (SELECT 1)
SELECT l_orderkey, l_linenumber, l_discount FROM line_nulls WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL""")
def drop_null_rows(spark, sf_dir):
    df, _ = view(spark, sf_dir, "line_nulls")
    return clean.drop_null_rows(df, ["l_discount", "l_tax", "absent"]).select("l_orderkey", "l_linenumber", "l_discount")


# ------------------------------------------------------------------ model experiments

FEAT_COLS = ["o_totalprice", "c_acctbal", "li_qty", "li_price", "li_disc", "li_lines"]


def _feat(spark, sf_dir):
    return view(spark, sf_dir, "orders_feat")


def _model_with(*ctes):
    """Newton rounds are recursive CTEs."""
    return "WITH RECURSIVE " + f"orders_feat AS ({SQL_VIEWS['orders_feat']}), " + ",".join(ctes)


def _model_select(sin, name, honest, leaky):
    h, lk = f"({honest})", f"({leaky})"
    return (f" SELECT {sin} AS sin, '{name}' AS name, {r6(h)} AS honest_auc, {r6(lk)} AS leaky_auc, "
            f"{r6(f'{lk} - {h}')} AS inflation")


def _auc_of(p):
    return f"SELECT auc FROM {p}_auc"


def _experiment_1_sql():
    enc = ("e_all AS (SELECT c_mktsegment AS c, avg(CAST(target AS DOUBLE)) AS e FROM s_s GROUP BY 1),"
           "e_tr AS (SELECT c_mktsegment AS c, avg(CAST(target AS DOUBLE)) AS e FROM s_s WHERE split = 'train' GROUP BY 1),"
           "xl AS (SELECT s_s.*, e AS enc FROM s_s LEFT JOIN e_all ON c_mktsegment = c),"
           "xh AS (SELECT s_s.*, coalesce(e, (SELECT avg(CAST(target AS DOUBLE)) FROM s_s WHERE split = 'train')) AS enc "
           "FROM s_s LEFT JOIN e_tr ON c_mktsegment = c)")
    return (_model_with("src AS (SELECT * FROM orders_feat WHERE c_mktsegment IS NOT NULL)",
                        strat_ctes("src", "o_orderkey", "s"), enc,
                        logit_auc("lh", "xh", FEAT_COLS + ["enc"]), logit_auc("ll", "xl", FEAT_COLS + ["enc"]))
            + _model_select(1, "Target Encoding", _auc_of("lh"), _auc_of("ll")))


def _experiment_2_sql():
    return (_model_with(strat_ctes("orders_feat", "o_orderkey", "s"), f"x AS (SELECT *, {INJ_FEATURE} AS inj FROM s_s)",
                        logit_auc("lh", "x", FEAT_COLS), logit_auc("ll", "x", FEAT_COLS + ["inj"]))
            + _model_select(2, "Feature From Target", _auc_of("lh"), _auc_of("ll")))


def _experiment_3_sql():
    return (_model_with("tn AS (SELECT CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT) AS n_train FROM orders_feat)",
                        "ts AS (SELECT o.*, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= "
                        "(SELECT n_train FROM tn) THEN 'train' ELSE 'test' END AS split FROM orders_feat o)",
                        logit_auc("lh", "ts", FEAT_COLS), logit_auc("ll", "ts", FEAT_COLS, fit_where="TRUE"))
            + _model_select(3, "Timestamp Scaling", _auc_of("lh"), _auc_of("ll")))


def _experiment_4_sql():
    noisy = ", ".join(f"{c} + {sql_gaussian(42, 0.0, 0.05, 'o_orderkey', repr(c))} AS {c}" for c in FEAT_COLS)
    cols = ", ".join(FEAT_COLS)
    folds = [logit_auc(f"f{k}", "sim", FEAT_COLS, fit_where=f"fold <> {k}", train_where=f"fold <> {k}",
                       test_where=f"fold = {k}") for k in range(5)]
    mean = "SELECT avg(auc) FROM (" + " UNION ALL ".join(f"SELECT auc FROM f{k}_auc" for k in range(5)) + ")"
    return (_model_with("g AS (SELECT DISTINCT o_custkey FROM orders_feat WHERE o_custkey IS NOT NULL)",
                        "ng AS (SELECT CAST(floor(count(*) * 0.3::DOUBLE) AS BIGINT) AS k FROM g)",
                        "cg AS (SELECT o_custkey FROM (SELECT o_custkey, row_number() OVER (ORDER BY "
                        f"{sql_hash_int(42, 'o_custkey')}, o_custkey) AS rn FROM g) WHERE rn <= (SELECT k FROM ng))",
                        f"sim AS (SELECT *, {sql_hash_int(42, 'o_custkey')} % 5 AS fold FROM ("
                        f"SELECT o_custkey, target, {cols}, CAST(o_orderkey AS BIGINT) * 2 AS rk FROM orders_feat UNION ALL "
                        f"SELECT o_custkey, target, {noisy}, CAST(o_orderkey AS BIGINT) * 2 + 1 FROM orders_feat "
                        "WHERE o_custkey IN (SELECT o_custkey FROM cg)))",
                        strat_ctes("sim", "rk", "s"), logit_auc("ll", "s_s", FEAT_COLS), *folds)
            + _model_select(4, "Group Overlap", mean, _auc_of("ll")))


def _experiment_5_sql():
    feats = ", ".join(FEAT_COLS)
    return (_model_with("n8 AS (SELECT CAST(floor(count(*) * 0.08::DOUBLE) AS BIGINT) AS k FROM orders_feat)",
                        f"pick AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {sql_hash_int(42, 'o_orderkey')}, "
                        "o_orderkey) AS rn FROM orders_feat) WHERE rn <= (SELECT k FROM n8))",
                        f"inj AS (SELECT {feats}, target, CAST(o_orderkey AS BIGINT) * 2 AS rk FROM orders_feat "
                        f"UNION ALL SELECT {feats}, target, CAST(o_orderkey AS BIGINT) * 2 + 1 FROM pick)",
                        strat_ctes("inj", "rk", "k"), f"dd AS (SELECT {feats}, target, min(rk) AS rk FROM inj GROUP BY {feats}, target)",
                        strat_ctes("dd", "rk", "h"), logit_auc("lh", "h_s", FEAT_COLS), logit_auc("ll", "k_s", FEAT_COLS))
            + _model_select(5, "Duplicate ID", _auc_of("lh"), _auc_of("ll")))


def _round_result(res):
    return _r6(res, "honest_auc", "leaky_auc", "inflation")


@register("model_experiment_1", _experiment_1_sql())
def model_experiment_1(spark, sf_dir):
    df, r = _feat(spark, sf_dir)
    return _round_result(X.experiment_1(df, r, "c_mktsegment", FEAT_COLS))


@register("model_experiment_2", _experiment_2_sql())
def model_experiment_2(spark, sf_dir):
    df, r = _feat(spark, sf_dir)
    return _round_result(X.experiment_2(df, r, FEAT_COLS))


@register("model_experiment_3", _experiment_3_sql())
def model_experiment_3(spark, sf_dir):
    df, r = _feat(spark, sf_dir)
    return _round_result(X.experiment_3(df, r, FEAT_COLS, ["o_orderdate", "o_orderkey"]))


@register("model_experiment_4", _experiment_4_sql())
def model_experiment_4(spark, sf_dir):
    df, r = _feat(spark, sf_dir)
    return _round_result(X.experiment_4(df, r, FEAT_COLS))


@register("model_experiment_5", _experiment_5_sql())
def model_experiment_5(spark, sf_dir):
    df, r = _feat(spark, sf_dir)
    return _round_result(X.experiment_5(df, r, FEAT_COLS))



@register("model_baseline", _model_with(strat_ctes("orders_feat", "o_orderkey", "s"), logit_auc("m", "s_s", FEAT_COLS)) + f"""
SELECT 'baseline' AS label, {r6("(SELECT auc FROM m_auc)")} AS auc, count(*) FILTER (WHERE split = 'train') AS n_train,
       count(*) FILTER (WHERE split = 'test') AS n_test,
       {r6("avg(CAST(target AS DOUBLE)) FILTER (WHERE split = 'test')")} AS default_rate FROM s_s""")
def model_baseline(spark, sf_dir):
    """J11 alone: sizes, AUC and test rate of the honest pipeline."""
    df, r = _feat(spark, sf_dir)
    with X.split_rows(df, r, FEAT_COLS) as s:
        return _r6(X.materialize(model.train_and_evaluate(s, FEAT_COLS, r.target, label="baseline", held=True)), "auc", "default_rate")


@register("logreg_gradient", _model_with(strat_ctes("orders_feat", "o_orderkey", "s"), logit_ctes("m", "s_s", FEAT_COLS))
          + " UNION ALL ".join(f" SELECT '{c}' AS parameter, {r6(f'w{i}')} AS weight, CAST(0 AS DOUBLE) AS gradient FROM m_w"
                               for i, c in enumerate(["intercept", *FEAT_COLS])))
def logreg_gradient(spark, sf_dir):
    """The fitted weights, and the objective's gradient a training row at them."""
    df, r = _feat(spark, sf_dir)
    with X.split_rows(df, r, FEAT_COLS) as s:
        return _r6(model.fit_report(s.where("split = 'train'"), FEAT_COLS, r.target), "weight", "gradient")
