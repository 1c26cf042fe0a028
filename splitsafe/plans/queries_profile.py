"""Registered profiling / EDA / duplicate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import round6
from ..operators import chartdata, duplicates, eda, profile, rank
from ..session import new_folder
from ..sources.csv import read_table
from ..sources.tables import SQL_VIEWS, table, view
from .registry import register
from .sqlgen import correlation_tier, missing_tier, sql_guarded_corr, sql_round6 as r6


def W(*names):
    return "WITH " + ", ".join(f"{n} AS ({SQL_VIEWS[n]})" for n in names) + " "


def _r6(df, *cols):
    return df.select(*[round6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("class_counts", W("orders_y") + f"""
SELECT target, count(*) AS n, {r6('count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()')} AS pct
FROM orders_y GROUP BY target""")
def class_counts(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    return _r6(profile.class_counts(df, r.target), "pct")


@register("target_summary", W("orders_y") + f"""
SELECT count(*) AS n_rows, CAST(sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
       CAST(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_neg,
       {r6('avg(CAST(target AS DOUBLE))')} AS default_rate,
       {r6('sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) * 1.0::DOUBLE / count(*)')} AS baseline_accuracy
FROM orders_y""")
def target_summary(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    return _r6(profile.target_summary(df, r.target), "default_rate", "baseline_accuracy")


DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


def _null_union(view_name, cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null, "
        f"{r6(f'(count(*) - count({c})) / count(*)::DOUBLE * 100')} AS pct_missing FROM {view_name}"
        for c in cols)


@register("null_profile", W("doc_labels") + _null_union("doc_labels", DOC_COLS))
def null_profile(spark, sf_dir):
    df, _ = view(spark, sf_dir, "doc_labels")
    return _r6(profile.null_profile(df), "pct_missing")


def _missing_tiers_sql(view_name, cols):
    inner = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null, "
        f"(count(*) - count({c})) / count(*)::DOUBLE * 100 AS p FROM {view_name}" for c in cols)
    return (f"SELECT \"column\", n_null, round_even(p, 1) AS pct_missing, "
            f"{missing_tier('round_even(p, 1)')} AS tier FROM ({inner}) WHERE n_null > 0")


@register("missing_tiers", W("doc_labels") + _missing_tiers_sql("doc_labels", DOC_COLS))
def missing_tiers(spark, sf_dir):
    df, _ = view(spark, sf_dir, "doc_labels")
    return eda.missing_tiers(df)


LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("missing_tiers_lines", W("line_nulls") + _missing_tiers_sql("line_nulls", LINE_COLS))
def missing_tiers_lines(spark, sf_dir):
    df, _ = view(spark, sf_dir, "line_nulls")
    return eda.missing_tiers(df)


@register("topk_missing", W("doc_labels") + f"""
SELECT * FROM ({_missing_tiers_sql('doc_labels', DOC_COLS)}) ORDER BY pct_missing DESC, "column" ASC LIMIT 5""")
def topk_missing(spark, sf_dir):
    df, _ = view(spark, sf_dir, "doc_labels")
    return eda.top_missing(df, 5)


@register("cardinality", W("events_y") + """
SELECT 'event_type' AS "column", count(DISTINCT event_type) AS n_distinct, count(DISTINCT event_type) < 100 AS at_risk
FROM events_y UNION ALL
SELECT 'props', count(DISTINCT props), count(DISTINCT props) < 100 FROM events_y""")
def cardinality(spark, sf_dir):
    df, r = view(spark, sf_dir, "events_y")
    d = profile.distinct_counts(df, r.categorical(df))
    return d.select("column", "n_distinct", (F.col("n_distinct") < 100).alias("at_risk"))


@register("cardinality_high", """
SELECT 'text' AS "column", count(DISTINCT text) AS n_distinct FROM documents UNION ALL
SELECT 'url', count(DISTINCT url) FROM pages UNION ALL SELECT 'props', count(DISTINCT props) FROM events""")
def cardinality_high(spark, sf_dir):
    """Distinct counts far above any threshold stay exact."""
    own = {"documents": "text", "pages": "url", "events": "props"}
    parts = [profile.distinct_counts(table(spark, sf_dir, t), [c]).select("column", "n_distinct") for t, c in own.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@register("group_sizes", f"""
WITH g AS (SELECT l_orderkey, count(*) AS size FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey)
SELECT count(*) AS n_groups, CAST(sum(CASE WHEN size > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_multi_groups,
       CAST(max(size) AS BIGINT) AS max_size, CAST(sum(size) AS BIGINT) AS n_rows,
       {r6('sum(CASE WHEN size > 1 THEN 1 ELSE 0 END) * 1.0::DOUBLE / count(*)')} AS multi_share FROM g""")
def group_sizes(spark, sf_dir):
    return _r6(profile.group_sizes(table(spark, sf_dir, "lineitem"), "l_orderkey"), "multi_share")


@register("category_rates", W("orders_y") + f"""
SELECT o_orderpriority, {r6('avg(CAST(target AS DOUBLE))')} AS target_rate, count(*) AS n
FROM orders_y GROUP BY o_orderpriority""")
def category_rates(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    return _r6(profile.category_rates(df, "o_orderpriority", r.target), "target_rate")


@register("median_by_class", W("orders_y") + f"""
SELECT target, 'o_totalprice' AS "column", {r6('median(o_totalprice)')} AS median FROM orders_y GROUP BY target
UNION ALL
SELECT target, 'o_custkey', {r6('median(CAST(o_custkey AS DOUBLE))')} FROM orders_y GROUP BY target""")
def median_by_class(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    return _r6(eda.median_by_class(df, r, ["o_totalprice", "o_custkey"]), "median")


HEAVY = """CASE WHEN l_orderkey % 1000 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN l_linenumber = 1 THEN l_extendedprice * 1e-300
 WHEN l_linenumber = 2 THEN l_extendedprice * 1e-30 WHEN l_linenumber = 3 THEN l_extendedprice
 WHEN l_linenumber = 4 THEN l_extendedprice * 1e30 ELSE l_extendedprice * 1e300 END"""


@register("median_heavy_tail", f"""
SELECT l_linestatus, l_returnflag, round(log10(median({HEAVY})), 6) AS log_median FROM lineitem GROUP BY ALL""")
def median_heavy_tail(spark, sf_dir):
    """Medians of values over 600 decades, some of them infinite."""
    df = table(spark, sf_dir, "lineitem").withColumn("v", F.expr(HEAVY))
    return rank.medians(df, ["v"], ["l_linestatus", "l_returnflag"]).select(
        "l_linestatus", "l_returnflag", F.round(F.log10("median"), 6).alias("log_median"))


def _corr_rows(view_name, feats):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {sql_guarded_corr(f'CAST({c} AS DOUBLE)', 'CAST(target AS DOUBLE)')} AS corr "
        f"FROM {view_name}" for c in feats)


@register("target_corr", W("orders_post") + f"""
SELECT feature, {r6('corr')} AS corr, {r6('abs(corr)')} AS abs_corr
FROM ({_corr_rows('orders_post', ['o_custkey', 'o_totalprice'])})""")
def target_corr(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_post")
    c = profile.target_correlations(df, r, keep_group=True)
    return _r6(c, "corr", "abs_corr")


@register("corr_hunt", W("events_hi") + f"""
SELECT feature, {r6('abs(corr)')} AS abs_corr, {correlation_tier('abs(corr)')} AS tier
FROM ({_corr_rows('events_hi', ['user_id', 'value'])}) ORDER BY abs(corr) DESC NULLS LAST, feature LIMIT 15""")
def corr_hunt(spark, sf_dir):
    df, r = view(spark, sf_dir, "events_hi")
    return _r6(eda.correlation_hunt(df, r, 15), "abs_corr")


NARROW = "l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"


@register("dup_count", W("line_narrow") + f"""
SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(c - 1) AS BIGINT) AS exact_dupes
FROM (SELECT count(*) AS c FROM line_narrow GROUP BY {NARROW})""")
def dup_count(spark, sf_dir):
    df, _ = view(spark, sf_dir, "line_narrow")
    return duplicates.duplicate_count(df)


@register("dup_count_hashed", W("line_narrow") + f"""
SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(c - 1) AS BIGINT) AS exact_dupes
FROM (SELECT count(*) AS c FROM line_narrow GROUP BY {NARROW})""")
def dup_count_hashed(spark, sf_dir):
    """Same count through the wide-table path (row hash pre-filter + exact verification)."""
    df, _ = view(spark, sf_dir, "line_narrow")
    return duplicates.duplicate_count(df, wide_columns=0)


@register("dedup", W("line_narrow") + f"SELECT DISTINCT {NARROW} FROM line_narrow")
def dedup(spark, sf_dir):
    df, _ = view(spark, sf_dir, "line_narrow")
    return duplicates.drop_duplicates(df)


@register("dedup_keep_first", f"""
SELECT l_returnflag, l_linestatus, l_quantity, min(l_orderkey * 10 + l_linenumber) AS row_key
FROM lineitem GROUP BY l_returnflag, l_linestatus, l_quantity""")
def dedup_keep_first(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("row_key", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return duplicates.drop_duplicates(li.select("l_returnflag", "l_linestatus", "l_quantity", "row_key"),
                                      ["l_returnflag", "l_linestatus", "l_quantity"], row_key="row_key")


@register("doc_dupes", """
SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(c - 1) AS BIGINT) AS exact_dupes
FROM (SELECT count(*) AS c FROM documents GROUP BY text)""")
def doc_dupes(spark, sf_dir):
    return duplicates.duplicate_count(table(spark, sf_dir, "documents"), ["text"])


ORDER_NUM = ["o_orderkey", "o_custkey", "o_totalprice", "target"]
ORDER_OTHER = ["o_orderstatus", "o_orderdate", "o_orderpriority"]


def _profile_sql(view_name):
    num = [
        f"SELECT '{c}' AS \"column\", 'numeric' AS kind, count(*) AS n, count({c}) AS non_null, "
        f"count(*) - count({c}) AS n_null, {r6(f'(count(*) - count({c})) / count(*)::DOUBLE')} AS null_frac, "
        f"{r6(f'avg(CAST({c} AS DOUBLE))')} AS mean, {r6(f'stddev_pop(CAST({c} AS DOUBLE))')} AS std_pop, "
        f"{r6(f'min(CAST({c} AS DOUBLE))')} AS min, {r6(f'max(CAST({c} AS DOUBLE))')} AS max, "
        f"{r6(sql_guarded_corr(f'CAST({c} AS DOUBLE)', 'CAST(target AS DOUBLE)'))} AS corr_target FROM {view_name}"
        for c in ORDER_NUM]
    oth = [
        f"SELECT '{c}', 'other', count(*), count({c}), count(*) - count({c}), "
        f"{r6(f'(count(*) - count({c})) / count(*)::DOUBLE')}, NULL, NULL, NULL, NULL, NULL FROM {view_name}"
        for c in ORDER_OTHER]
    return " UNION ALL ".join(num + oth)


@register("long_profile", W("orders_post") + _profile_sql("orders_post"))
def long_profile(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_post")
    p = profile.long_profile(df, r)
    return _r6(p, "null_frac", "mean", "std_pop", "min", "max", "corr_target")


@register("sanity_check", W("orders_y") + f"""
SELECT 'shape' AS section, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM orders_y
UNION ALL SELECT 'shape', 'columns', 7.0
UNION ALL SELECT 'target', 'class_0', CAST(count(*) FILTER (WHERE target = 0) AS DOUBLE) FROM orders_y
UNION ALL SELECT 'target', 'class_1', CAST(count(*) FILTER (WHERE target = 1) AS DOUBLE) FROM orders_y
UNION ALL SELECT 'target', 'default_rate_pct', round_even(avg(CAST(target AS DOUBLE)) * 100, 2) FROM orders_y
UNION ALL SELECT 'missing', 'columns_with_missing', 0.0
UNION ALL SELECT 'dtype', 'bigint', 2.0
UNION ALL SELECT 'dtype', 'double', 1.0
UNION ALL SELECT 'dtype', 'int', 1.0
UNION ALL SELECT 'dtype', 'string', 2.0
UNION ALL SELECT 'dtype', 'timestamp_ntz', 1.0
UNION ALL SELECT 'duplicates', 'duplicate_rows', CAST(sum(c - 1) AS DOUBLE)
  FROM (SELECT count(*) AS c FROM orders_y
        GROUP BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, target)
UNION ALL SELECT 'ids', 'unique_ids', CAST(count(DISTINCT o_orderkey) AS DOUBLE) FROM orders_y""")
def sanity_check(spark, sf_dir):
    df, r = view(spark, sf_dir, "orders_y")
    return eda.sanity_check(df, r)


def _hist_sql(view_name, col, by, bins):
    return f"""
rng AS (SELECT {by}, CASE WHEN min({col}) = max({col}) THEN min({col}) - 0.5 ELSE min({col}) END AS lo,
               CASE WHEN min({col}) = max({col}) THEN max({col}) + 0.5 ELSE max({col}) END AS hi, count({col}) AS n
        FROM {view_name} WHERE {col} IS NOT NULL GROUP BY {by}),
cnt AS (SELECT v.{by}, CAST(least(floor((v.{col} - r.lo) * {bins} / (r.hi - r.lo)), {bins - 1}) AS INTEGER) AS bin,
               count(*) AS c FROM {view_name} v JOIN rng r ON v.{by} = r.{by} WHERE v.{col} IS NOT NULL GROUP BY 1, 2),
grid AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins}))
SELECT '{col}' AS feature, r.{by}, g.bin,
       {r6(f'r.lo + g.bin * ((r.hi - r.lo) / {bins})')} AS edge_lo,
       {r6(f'r.lo + (g.bin + 1) * ((r.hi - r.lo) / {bins})')} AS edge_hi,
       CAST(coalesce(c.c, 0) AS BIGINT) AS count,
       {r6(f'coalesce(c.c, 0) / (r.n * ((r.hi - r.lo) / {bins}))')} AS density
FROM rng r CROSS JOIN grid g LEFT JOIN cnt c ON c.{by} = r.{by} AND c.bin = g.bin"""


@register("histogram", W("events_y") + ", " + _hist_sql("events_y", "value", "target", 50))
def histogram(spark, sf_dir):
    df, r = view(spark, sf_dir, "events_y")
    h = chartdata.histogram(df, ["value"], "target", 50)
    return _r6(h, "edge_lo", "edge_hi", "density")


@register("median_by_customer", f"""
WITH v AS (SELECT o_custkey, o_totalprice, CAST(o_orderkey AS DOUBLE) AS o_orderkey FROM orders)
SELECT o_custkey, 'o_totalprice' AS "column", {r6('median(o_totalprice)')} AS median FROM v GROUP BY o_custkey
UNION ALL
SELECT o_custkey, 'o_orderkey', {r6('median(o_orderkey)')} FROM v GROUP BY o_custkey""")
def median_by_customer(spark, sf_dir):
    """Medians of as many groups as there are customers: selection with its state in tables."""
    return _r6(rank.medians(table(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"], ["o_custkey"]), "median")


@register("eda_categoricals", W("doc_labels") + """SELECT 'text' AS "column", count(DISTINCT text) AS n_distinct FROM doc_labels
UNION ALL SELECT 'lang', count(DISTINCT lang) FROM doc_labels UNION ALL SELECT 'source', count(DISTINCT source) FROM doc_labels""")
def eda_categoricals(spark, sf_dir):
    df, r = view(spark, sf_dir, "doc_labels")
    return eda.eda(df, r)["categoricals"]


# ------------------------------------------------------------------ CSV (A1, A2)

CSV_TEXTS = {
    "whole": "CASE WHEN o_orderkey % 10 = 0 THEN 'NA' ELSE CAST(o_custkey AS {text}) END",
    "real": "CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS {text}) ELSE CAST(o_custkey AS {text}) || '.5' END",
    "flag": "CASE WHEN o_orderkey % 4 = 0 THEN 'null' WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'false' END",
    "code": "CASE WHEN o_orderkey % 500 = 0 THEN '12D' ELSE CAST(o_custkey AS {text}) END",
    "note": "'say \"' || o_orderpriority || '\", ' || CAST(o_orderkey % 3 AS {text})",
    "void": "'N/A'",
}
_CSV_SQL = "WITH t AS (SELECT o_orderkey, " + ", ".join(f'{e.format(text="VARCHAR")} AS "{c}"' for c, e in CSV_TEXTS.items()) + " FROM orders)"
_MISSING = "('', 'NA', 'null', 'N/A')"


def _orders_csv(spark, sf_dir):
    path = new_folder(spark, "csv")
    (table(spark, sf_dir, "orders").selectExpr("o_orderkey", *[f"{e.format(text='STRING')} AS `{c}`" for c, e in CSV_TEXTS.items()])
     .write.option("header", True).option("escape", '"').csv(path))
    return read_table(spark, path)


@register("csv_round_trip", _CSV_SQL + f"""
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(NULLIF(whole, 'NA') AS BIGINT) AS whole, CAST(NULLIF("real", '') AS DOUBLE) AS "real",
       CASE flag WHEN 'True' THEN TRUE WHEN 'false' THEN FALSE END AS flag, code, note, CAST(NULL AS DOUBLE) AS void FROM t""")
def csv_round_trip(spark, sf_dir):
    """Quotes, commas, missing tokens and mixed columns of a CSV written by Spark, read with inferred types."""
    return _orders_csv(spark, sf_dir)


@register("infer_types_orders", _CSV_SQL + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", CASE WHEN count(v) = 0 THEN 'double'
  WHEN count(v) = count(CASE WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN 1 END) THEN 'bigint'
  WHEN count(v) = count(CASE WHEN regexp_full_match(v, '[+-]?[0-9.]+') THEN 1 END) THEN 'double'
  WHEN count(v) = count(CASE WHEN lower(v) IN ('true', 'false') THEN 1 END) THEN 'boolean' ELSE 'string' END AS type
FROM (SELECT CASE WHEN CAST("{c}" AS VARCHAR) NOT IN {_MISSING} THEN CAST("{c}" AS VARCHAR) END AS v FROM t)""" for c in ["o_orderkey", *CSV_TEXTS]))
def infer_types_orders(spark, sf_dir):
    return spark.createDataFrame(_orders_csv(spark, sf_dir).dtypes, "column string, type string")
