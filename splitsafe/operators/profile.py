"""Column profiling in a few fused passes.

The central idea is the *long profile*: stack every column into
``(column, x)`` next to the target and run ONE ``groupBy(column)`` that yields
null counts, mean, population std and the guarded target correlation of every
column at once.  The stack is a ``posexplode`` inside whole-stage
codegen, the partial aggregate collapses each task's rows to one row per column
before the shuffle, and the plan size does not grow with the number of columns
(one wide ``agg`` of 3 x 120 expressions is compile-bound).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from functools import reduce

from ..functions.numeric import NUMERIC_TYPES, as_double, guarded_corr
from ..roles import Roles

STACK_CHUNK = 48


def stack_columns(df: DataFrame, values: dict, keep=(), chunk: int = STACK_CHUNK,
                  slot: str = "__slot", value: str = "x") -> DataFrame:
    """Long form ``keep..., slot (int), value`` of ``values`` = {name: Column}.

    The values become one array a row, exploded with its positions: a slot is the position, so no name is
    parsed for each value (``unpivot`` names its columns in text, which took most of a wide scan's time).
    Wide inputs are stacked in chunks of ``chunk`` columns (each chunk's scan is pruned to its own columns)
    and the chunks are unioned: an array of very many expressions makes a method too long to be compiled.
    Slot ids are integers; callers map them to names after aggregating (a few rows).
    """
    items = list(values.values())
    keep = list(keep)
    parts = []
    for start in range(0, len(items), chunk):
        long = df.select(*keep, F.posexplode(F.array(*items[start:start + chunk])).alias(slot, value))
        parts.append(long.withColumn(slot, F.col(slot) + F.lit(start)) if start else long)
    return reduce(DataFrame.unionByName, parts)


def slot_names(values: dict, slot: str = "__slot") -> F.Column:
    """Column name of an integer slot of :func:`stack_columns` (apply after aggregation)."""
    names = list(values)
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.col(slot) + 1)


def long_profile(df: DataFrame, roles: Roles | None = None, columns=None,
                 with_target: bool = True) -> DataFrame:
    """One row per column: ``column, kind, n, non_null, n_null, null_frac, mean, std_pop,
    min, max, corr_target``.

    Numeric columns are cast to DOUBLE (NaN → NULL); for every other type only the
    null flag is profiled (``kind = 'other'``), so the stack holds one value type.
    """
    columns = list(columns) if columns is not None else list(df.columns)
    fields = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in columns if isinstance(fields[c], NUMERIC_TYPES)]
    target = roles.target if (roles is not None and with_target) else None

    vals = {}
    for c in columns:
        if c in numeric:
            vals[c] = as_double(df, c)
        else:  # presence only: 0.0 when present, NULL when missing
            vals[c] = F.when(F.col(c).isNotNull(), F.lit(0.0))
    y = (F.col(target).cast("double") if target else F.lit(None).cast("double")).alias("__y")
    long = stack_columns(df.select("*", y), vals, keep=["__y"])

    prof = long.groupBy("__slot").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("x").alias("non_null"),
        F.avg("x").alias("mean"),
        F.stddev_pop("x").alias("std_pop"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        guarded_corr(F.col("x"), F.col("__y")).alias("corr_target"),
    ).withColumn("column", slot_names(vals)).drop("__slot")
    is_num = F.col("column").isin(numeric) if numeric else F.lit(False)
    return prof.select(
        "column",
        F.when(is_num, F.lit("numeric")).otherwise(F.lit("other")).alias("kind"),
        "n", "non_null",
        (F.col("n") - F.col("non_null")).alias("n_null"),
        F.try_divide(F.col("n") - F.col("non_null"), F.col("n")).alias("null_frac"),
        *[F.when(is_num, F.col(c)).alias(c) for c in ("mean", "std_pop", "min", "max", "corr_target")],
    )


def correlation_profile(df: DataFrame, target: str, columns) -> DataFrame:
    """``column, corr_target`` only: the guarded Pearson correlation of each numeric column
    with the target, from one stacked aggregate (lighter than the full long profile)."""
    vals = {c: as_double(df, c) for c in columns}
    y = F.col(target).cast("double").alias("__y")
    long = stack_columns(df.select("*", y), vals, keep=["__y"])
    return (long.groupBy("__slot").agg(guarded_corr(F.col("x"), F.col("__y")).alias("corr_target"))
            .select(slot_names(vals).alias("column"), "corr_target"))


def null_profile(df: DataFrame, columns=None) -> DataFrame:
    """``column, n_null, pct_missing`` (percent, unrounded) for every column."""
    p = long_profile(df, None, columns, with_target=False)
    return p.select("column", "n_null", (F.col("null_frac") * 100).alias("pct_missing"))


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """One row per class with count and percent of all rows."""
    counts = df.groupBy(F.col(target).alias("target")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.select("target", "n", (F.col("n") * 100.0 / total).alias("pct"))


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """E2 in one row: rows, positives, negatives, default rate, majority-baseline accuracy."""
    y = F.col(target)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("bigint").alias("n_pos"),
        F.sum(F.when(y == 0, 1).otherwise(0)).cast("bigint").alias("n_neg"),
        F.avg(y.cast("double")).alias("default_rate"),
    ).withColumn("baseline_accuracy", F.try_divide(F.col("n_neg") * 1.0, F.col("n_rows")))


def distinct_counts(df: DataFrame, columns, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """Non-null distinct count per column, exact at any size.

    The columns are stacked (codegen-sized chunks); distinct (column, value) pairs are made
    by a partially aggregated shuffle and then counted, so no task holds a column's values.
    ``approx=True`` asks for the one-pass sketch instead, and says so in ``exact``.  One row
    per column is collected; a column without values is filled with 0.
    """
    columns = list(columns)
    schema = T.StructType([T.StructField("column", T.StringType()),
                           T.StructField("n_distinct", T.LongType()),
                           T.StructField("exact", T.BooleanType())])
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], schema)
    long = stack_columns(df, {c: F.col(c).cast("string") for c in columns}, value="value").where(F.col("value").isNotNull())
    if approx:
        found = long.groupBy("__slot").agg(F.approx_count_distinct("value", rsd).alias("n"))
    else:
        found = long.select("__slot", "value").distinct().groupBy("__slot").agg(F.count(F.lit(1)).alias("n"))
    n = {columns[r["__slot"]]: r["n"] for r in found.collect()}
    rows = [(c, int(n.get(c, 0)), not approx) for c in columns]
    order = {c: i for i, c in enumerate(columns)}
    return spark.createDataFrame(sorted(rows, key=lambda r: order[r[0]]), schema)


def group_sizes(df: DataFrame, key: str) -> DataFrame:
    """Groups, groups with more than one row, share (NULL keys ignored, like value_counts).

    ``count`` is combinable, so a key holding a third of all rows costs one partial
    aggregate per task, not a hot reducer.
    """
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    return per.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.coalesce(F.sum(F.when(F.col("size") > 1, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("n_multi_groups"),
        F.coalesce(F.max("size"), F.lit(0)).cast("bigint").alias("max_size"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("n_rows"),
    ).withColumn("multi_share", F.try_divide(F.col("n_multi_groups") * 1.0, F.col("n_groups")))


def category_rates(df: DataFrame, category: str, target: str) -> DataFrame:
    """Mean target and row count per category (NULL category kept as its own row)."""
    return df.groupBy(category).agg(F.avg(F.col(target).cast("double")).alias("target_rate"),
                                    F.count(F.lit(1)).alias("n"))


def target_correlations(df: DataFrame, roles: Roles, keep_group: bool = True) -> DataFrame:
    """``feature, corr, abs_corr`` for numeric features (NULL for constants)."""
    feats = roles.numeric(df, keep_group=keep_group)
    if not feats:
        schema = "feature string, corr double, abs_corr double"
        return df.sparkSession.createDataFrame([], schema)
    p = correlation_profile(df, roles.target, feats)
    return p.select(F.col("column").alias("feature"), F.col("corr_target").alias("corr"),
                    F.abs("corr_target").alias("abs_corr"))
