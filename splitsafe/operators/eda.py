"""Sanity report (E16) and EDA report (E17) as DataFrames.

Both are compositions of the profiling operators: the long profile (nulls,
correlations), the class counts, a duplicate count and id counts.  Schema facts
(column types, role breakdown) come from the schema without a job.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tiers
from ..functions.numeric import round_half_even
from ..roles import Roles
from .duplicates import duplicate_count
from .profile import class_counts, distinct_counts, group_sizes, long_profile, null_profile, target_correlations
from .rank import medians


def _metric(df: DataFrame, section: str, metric: str, value) -> DataFrame:
    return df.select(F.lit(section).alias("section"), F.lit(metric).alias("metric"),
                     value.cast("double").alias("value"))


def sanity_check(df: DataFrame, roles: Roles, top: int = 5) -> DataFrame:
    """Long ``section, metric, value`` table: shape, classes, missing, dtypes, duplicates, ids."""
    spark = df.sparkSession
    n_cols = len(df.columns)
    parts = []
    prof = long_profile(df, None, with_target=False)
    shape = prof.agg(F.max("n").alias("n"))
    parts.append(_metric(shape, "shape", "rows", F.coalesce(F.col("n"), F.lit(0))))
    parts.append(_metric(spark.range(1), "shape", "columns", F.lit(n_cols)))
    if roles.target in df.columns:
        y = F.col(roles.target)
        t = df.agg(F.count(F.when(y == 0, 1)).alias("n0"), F.count(F.when(y == 1, 1)).alias("n1"),
                   F.avg(y.cast("double")).alias("rate"))
        parts += [_metric(t, "target", "class_0", F.col("n0")), _metric(t, "target", "class_1", F.col("n1")),
                  _metric(t, "target", "default_rate_pct", round_half_even(F.col("rate") * 100, 2))]
    miss = prof.where(F.col("n_null") > 0).select(
        "column", round_half_even(F.col("null_frac") * 100, 2).alias("pct"))
    parts.append(_metric(miss.agg(F.count(F.lit(1)).alias("c")), "missing", "columns_with_missing", F.col("c")))
    topk = miss.orderBy(F.desc("pct"), F.asc("column")).limit(top)
    parts.append(topk.select(F.lit("missing_top").alias("section"), F.col("column").alias("metric"),
                             F.col("pct").alias("value")))
    dtypes = Counter(f.dataType.simpleString() for f in df.schema.fields)
    for dt, c in sorted(dtypes.items()):
        parts.append(_metric(spark.range(1), "dtype", dt, F.lit(c)))
    dup = duplicate_count(df)
    parts.append(_metric(dup, "duplicates", "duplicate_rows", F.col("exact_dupes")))
    if roles.id and roles.id in df.columns:
        ids = df.agg(F.count_distinct(roles.id).alias("u"))
        parts.append(_metric(ids, "ids", "unique_ids", F.col("u")))
    return reduce(DataFrame.unionByName, parts)


def role_breakdown(df: DataFrame, roles: Roles) -> DataFrame:
    """E17 feature types: id / target / numeric features / categorical / total (schema only)."""
    spark = df.sparkSession
    num = roles.numeric(df, keep_group=True)
    cat = [c for c in roles.categorical(df)]
    rows = [("id", 1 if roles.id in df.columns else 0), ("target", 1), ("numeric", len(num)),
            ("categorical", len(cat)), ("total", len(df.columns))]
    return spark.createDataFrame(rows, "role string, n int")


def categorical_counts(df: DataFrame, roles: Roles) -> DataFrame:
    """Distinct non-null values of every categorical column, most first: ``column, n_distinct``."""
    return (distinct_counts(df, roles.categorical(df)).select("column", "n_distinct")
            .orderBy(F.desc("n_distinct"), F.asc("column")))


def missing_tiers(df: DataFrame) -> DataFrame:
    """E5/L2: columns with any missing value, percent rounded half-even to 1 decimal, tier."""
    p = null_profile(df).where(F.col("n_null") > 0)
    pct = round_half_even(F.col("pct_missing"), 1)
    return p.select("column", "n_null", pct.alias("pct_missing"), tiers.missing_tier(pct).alias("tier"))


def top_missing(df: DataFrame, k: int = 30) -> DataFrame:
    """G1/L2: top-k columns by missing percent (name breaks ties)."""
    return missing_tiers(df).orderBy(F.desc("pct_missing"), F.asc("column")).limit(k)


def correlation_hunt(df: DataFrame, roles: Roles, k: int = 15) -> DataFrame:
    """Top-k |corr| with target among numeric features (minus target and id)."""
    c = target_correlations(df, roles, keep_group=False)
    return (c.select("feature", "abs_corr", tiers.correlation_tier("abs_corr").alias("tier"))
            .orderBy(F.desc_nulls_last("abs_corr"), F.asc("feature")).limit(k))


def median_by_class(df: DataFrame, roles: Roles, features, **kw) -> DataFrame:
    """Exact median of each feature per class."""
    feats = [f for f in features if f in df.columns]
    return medians(df.where(F.col(roles.target).isNotNull()), feats, [roles.target], **kw)


def eda(df: DataFrame, roles: Roles, key_features=()) -> dict:
    """The EDA report as a dict of lazy DataFrames."""
    return {
        "classes": class_counts(df, roles.target),
        "roles": role_breakdown(df, roles),
        "categoricals": categorical_counts(df, roles),
        "missing": missing_tiers(df),
        "correlations": correlation_hunt(df, roles),
        "medians": median_by_class(df, roles, key_features) if key_features else None,
        "groups": group_sizes(df, roles.group) if roles.group else None,
    }
