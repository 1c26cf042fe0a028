"""Registered detector queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import detector
from ..session import new_folder
from ..sources.csv import write_report
from ..sources.tables import SQL_VIEWS, _wide_exprs, view
from . import sqlgen
from .registry import register

REPORT_FLAT = ["check", "name", "risk", "message", "fix", "exact_dupes", "id_dupes",
               "n_groups", "n_multi_groups", "n_flagged", "weight"]

# Schemas of the labelled views, spelled out for the oracle SQL.
VIEW_SCHEMAS = {
    "orders_y": dict(columns=["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                              "o_orderpriority", "target"],
                     cats=["o_orderstatus", "o_orderpriority"], nums=["o_custkey", "o_totalprice"],
                     time_cols=["o_orderdate"], group="o_custkey", id_="o_orderkey"),
    "events_y": dict(columns=["event_id", "ts", "user_id", "event_type", "value", "props", "target"],
                     cats=["event_type", "props"], nums=["user_id", "value"], time_cols=[],
                     group="user_id", id_="event_id"),
    "events_hi": dict(columns=["event_id", "ts", "user_id", "event_type", "value", "props", "target"],
                      cats=["event_type", "props"], nums=["user_id", "value"], time_cols=[],
                      group=None, id_="event_id"),
}
VIEW_SCHEMAS["orders_post"] = dict(VIEW_SCHEMAS["orders_y"])
_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
         "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_WIDE = [n for n, _, _ in _wide_exprs(False)]
VIEW_SCHEMAS["line_wide"] = dict(
    columns=_LINE + _WIDE + ["target"], cats=["l_returnflag", "l_linestatus"],
    nums=["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"] + _WIDE,
    time_cols=["l_shipdate"], group="l_orderkey", id_="l_orderkey")


def _scan_sql(v: str, body: str) -> str:
    return (f"WITH {v} AS ({SQL_VIEWS[v]}), " + sqlgen.scan_report_sql(v, **VIEW_SCHEMAS[v]).strip()
            + " " + body)


@register("scan_report", _scan_sql("orders_y", sqlgen.scan_report_select()))
def scan_report(spark, sf_dir) -> DataFrame:
    df, roles = view(spark, sf_dir, "orders_y")
    return detector.scan(df, roles).select(*REPORT_FLAT)


SCAN_VIEWS = ["orders_y", "orders_post", "events_y", "events_hi"]


@register("scan_score", " UNION ALL ".join(
    f"SELECT * FROM ({_scan_sql(v, sqlgen.scan_score_select(v))})" for v in SCAN_VIEWS))
def scan_score(spark, sf_dir) -> DataFrame:
    from ..operators.concurrent import run_concurrently

    def one(v):
        df, roles = view(spark, sf_dir, v)
        return detector.score(detector.scan(df, roles)).select(F.lit(v).alias("view"), "*")

    # each scan's cardinality pre-pass runs at construction: build the four concurrently
    parts = run_concurrently(*[(lambda v=v: one(v)) for v in SCAN_VIEWS])
    return reduce(DataFrame.unionByName, parts)


@register("scan_report_post", _scan_sql("orders_post", sqlgen.scan_report_select()))
def scan_report_post(spark, sf_dir) -> DataFrame:
    df, roles = view(spark, sf_dir, "orders_post")
    return detector.scan(df, roles).select(*REPORT_FLAT)


@register("scan_report_events", _scan_sql("events_y", sqlgen.scan_report_select()))
def scan_report_events(spark, sf_dir) -> DataFrame:
    df, roles = view(spark, sf_dir, "events_y")
    return detector.scan(df, roles).select(*REPORT_FLAT)


@register("severity_chart", _scan_sql("events_hi", (
    "SELECT \"check\", name, risk, CAST(" + sqlgen.case(
        [(f"risk = '{k}'", v) for k, v in
         {"CRITICAL": 5.0, "HIGH": 4.0, "MEDIUM": 3.0, "LOW": 2.0, "CLEAN": 1.0, "UNKNOWN": 1.5}.items()],
        1.0) + " AS DOUBLE) AS severity FROM rep")))
def severity_chart(spark, sf_dir) -> DataFrame:
    df, roles = view(spark, sf_dir, "events_hi")
    return detector.severity_chart(detector.scan(df, roles))


@register("wide_scan", _scan_sql("line_wide", sqlgen.scan_report_select()))
def wide_scan(spark, sf_dir) -> DataFrame:
    """The detector on a 120-column table: one long-profile pass, hashed duplicate check."""
    df, roles = view(spark, sf_dir, "line_wide")
    return detector.scan(df, roles).select(*REPORT_FLAT)


@register("score_bar", f"""WITH s AS ({_scan_sql("orders_y", sqlgen.scan_score_select("orders_y"))})
SELECT level, 'score' AS part, 0 AS "left", score AS width FROM s UNION ALL SELECT level, 'rest', score, 100 - score FROM s""")
def score_bar(spark, sf_dir) -> DataFrame:
    df, roles = view(spark, sf_dir, "orders_y")
    return detector.score_bar(detector.score(detector.scan(df, roles)))


@register("scan_flagged", f"""WITH orders_post AS ({SQL_VIEWS["orders_post"]}),
c AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs({sqlgen.sql_guarded_corr(f'CAST({c} AS DOUBLE)', 'CAST(target AS DOUBLE)')}) AS a FROM orders_post"
    for c in VIEW_SCHEMAS["orders_post"]["nums"]) + """),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY a DESC, feature) AS INTEGER) AS place FROM c WHERE a > 0.5)
SELECT place, feature, round_even(a, 4) AS corr FROM r WHERE place <= 5""")
def scan_flagged(spark, sf_dir) -> DataFrame:
    """The features that check 2 names, with their correlations."""
    df, roles = view(spark, sf_dir, "orders_post")
    rep = detector.check_correlation(df, roles)
    return rep.select(F.posexplode("flagged").alias("at", "f")).select((F.col("at") + 1).alias("place"), "f.feature", "f.corr")


@register("report_sink", _scan_sql("orders_y", 'SELECT "check", name, risk, message FROM rep'))
def report_sink(spark, sf_dir) -> DataFrame:
    """A5: the report written to the shared folder and read back."""
    df, roles = view(spark, sf_dir, "orders_y")
    path = new_folder(spark, "report")
    write_report(detector.scan(df, roles).select("check", "name", "risk", "message"), path)
    return spark.read.parquet(path)
