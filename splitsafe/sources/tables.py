"""Parquet sources (A3) and the labelled views the audit runs on.

Each view is a lazy DataFrame over the driver's parquet tables plus a
:class:`~splitsafe.roles.Roles` record; Catalyst prunes the scan to the columns a
query touches and pushes filters into the parquet reader.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..roles import Roles

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _flag(cond) -> F.Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("int")


def orders_y(spark, sf_dir):
    """orders + target = (o_orderstatus = 'F'); id o_orderkey, group o_custkey, time o_orderdate."""
    df = table(spark, sf_dir, "orders").withColumn("target", _flag(F.col("o_orderstatus") == "F"))
    return df, Roles(target="target", id="o_orderkey", group="o_custkey", time="o_orderdate",
                     row_key="o_orderkey")


def orders_post(spark, sf_dir):
    """orders + target = (o_totalprice > 250000): a feature computed from the outcome."""
    df = table(spark, sf_dir, "orders").withColumn("target", _flag(F.col("o_totalprice") > 250000))
    return df, Roles(target="target", id="o_orderkey", group="o_custkey", time="o_orderdate",
                     row_key="o_orderkey")


def events_y(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumn("target", _flag(F.col("event_type") == "purchase"))
    return df, Roles(target="target", id="event_id", group="user_id", time="ts", row_key="event_id")


def events_hi(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumn("target", _flag(F.col("value") > 35))
    return df, Roles(target="target", id="event_id", time="ts", row_key="event_id")


def doc_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    df = docs.join(labels, "doc_id", "left")
    return df, Roles(target="quality", id="doc_id", row_key="doc_id")


def line_narrow(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return df, Roles(target="l_quantity")


def line_nulls(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    df = li.withColumn("l_discount", F.when(F.col("l_discount") != 0, F.col("l_discount")))
    return df, Roles(target="l_quantity")


def orders_feat(spark, sf_dir):
    """orders JOIN customer + per-order lineitem sums: the model-experiment table.

    The lineitem aggregate and orders are both hash-partitioned on the order key,
    so the join needs one exchange per side and no broadcast of a growing table.
    """
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    lines = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
             .agg(F.sum("l_quantity").alias("li_qty"),
                  F.sum("l_extendedprice").alias("li_price"),
                  F.avg("l_discount").alias("li_disc"),
                  F.count(F.lit(1)).alias("li_lines")))
    df = (orders.join(cust, orders.o_custkey == cust.c_custkey, "inner").drop("c_custkey")
          .join(lines, orders.o_orderkey == lines.l_orderkey, "left").drop("l_orderkey")
          .withColumn("target", _flag(F.col("o_orderstatus") == "F")))
    return df, Roles(target="target", id="o_orderkey", group="o_custkey", time="o_orderdate",
                     row_key="o_orderkey")


WIDE_DERIVED = 108          # 11 lineitem columns + target + 108 derived = 120 columns


def _wide_exprs(spark_cols: bool = True):
    """(name, spark column, sql text) of the derived numeric columns: integer-literal arithmetic on
    lineitem values, so Spark and DuckDB compute bit-identical results."""
    out = []
    for k in range(WIDE_DERIVED):
        a, b = k % 7 + 1, k % 5 + 2
        name = f"w{k:03d}"
        if k % 3 == 0:
            col = (lambda a=a, b=b: F.col("l_extendedprice") * a + F.col("l_tax") * b)
            sql = f"l_extendedprice * {a} + l_tax * {b}"
        elif k % 3 == 1:
            col = (lambda a=a, b=b: F.col("l_quantity") * b - F.col("l_discount") * a)
            sql = f"l_quantity * {b} - l_discount * {a}"
        else:
            col = (lambda m=k + 2: (F.col("l_partkey") % m).cast("bigint"))
            sql = f"CAST(l_partkey % {k + 2} AS BIGINT)"
        out.append((name, col() if spark_cols else None, sql))
    return out


def line_wide(spark, sf_dir):
    """A 120-column table derived from lineitem (width stress for profiling and duplicates)."""
    li = table(spark, sf_dir, "lineitem")
    df = li.select("*", *[c.alias(n) for n, c, _ in _wide_exprs()],
                   _flag(F.col("l_returnflag") == "R").alias("target"))
    return df, Roles(target="target", id="l_orderkey", group="l_orderkey", time="l_shipdate")


QUIRKS = {"id": "o_custkey % 400", "DAYS_BIRTH": "-((o_custkey % 400) * 37 + 7000)",
          "DAYS_EMPLOYED": "CASE WHEN o_custkey % 5 = 0 THEN 365243 ELSE -(o_custkey % 400) END",
          "sparse": "CASE WHEN o_custkey % 4 = 0 THEN 1.5E0 END", "prio": "o_orderpriority",
          "target": "CAST(o_custkey % 400 % 3 = 0 AS INTEGER)"}


def orders_quirks(spark, sf_dir):
    """What cleaning looks for: repeated rows, a sentinel, signed day counts, a mostly missing and a text column."""
    df = table(spark, sf_dir, "orders").selectExpr(*[f"{sql.replace('INTEGER', 'INT')} AS `{c}`" for c, sql in QUIRKS.items()])
    return df, Roles(target="target", id="id", row_key="id")


VIEWS = {
    "orders_quirks": orders_quirks,
    "orders_y": orders_y, "orders_post": orders_post, "events_y": events_y,
    "events_hi": events_hi, "doc_labels": doc_labels, "line_narrow": line_narrow,
    "line_nulls": line_nulls, "orders_feat": orders_feat, "line_wide": line_wide,
}


def view(spark, sf_dir, name):
    return VIEWS[name](spark, sf_dir)


# DuckDB definitions of the same views (used inside oracle SQL as CTEs).
SQL_VIEWS = {
    "orders_y": "SELECT *, CAST(o_orderstatus = 'F' AS INTEGER) AS target FROM orders",
    "orders_post": "SELECT *, CAST(o_totalprice > 250000 AS INTEGER) AS target FROM orders",
    "events_y": "SELECT *, CAST(event_type = 'purchase' AS INTEGER) AS target FROM events",
    "events_hi": "SELECT *, CAST(value > 35 AS INTEGER) AS target FROM events",
    "doc_labels": "SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)",
    "line_narrow": "SELECT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem",
    "line_nulls": "SELECT * REPLACE (CASE WHEN l_discount <> 0 THEN l_discount END AS l_discount) "
                  "FROM lineitem",
    "orders_feat": (
        "SELECT o.*, c.c_acctbal, c.c_mktsegment, li.li_qty, li.li_price, li.li_disc, li.li_lines, "
        "CAST(o.o_orderstatus = 'F' AS INTEGER) AS target "
        "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
        "LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS li_qty, sum(l_extendedprice) AS li_price, "
        "avg(l_discount) AS li_disc, count(*) AS li_lines FROM lineitem GROUP BY l_orderkey) li "
        "ON o.o_orderkey = li.l_orderkey"),
}


SQL_VIEWS["line_wide"] = ("SELECT *, " + ", ".join(f"{sql} AS {n}" for n, _, sql in _wide_exprs(False))
                          + ", CAST(l_returnflag = 'R' AS INTEGER) AS target FROM lineitem")


SQL_VIEWS["orders_quirks"] = "SELECT " + ", ".join(f'{sql} AS "{c}"' for c, sql in QUIRKS.items()) + " FROM orders"


def sql_with(*names: str) -> str:
    """``WITH name AS (...), ...`` prefix for oracle SQL."""
    return "WITH " + ", ".join(f"{n} AS ({SQL_VIEWS[n]})" for n in names) + " "
