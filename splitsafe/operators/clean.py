"""Cleaning pipeline (J1): drop mostly-missing columns → de-duplicate → fix quirks →
keep numeric columns, in that order.

Two jobs: the null-fraction profile (one long-profile pass, a schema-sized
result decides which columns go) and then the lazy cleaned frame.  A cleaning
log records what each step did.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import NUMERIC_TYPES
from .duplicates import drop_duplicates, duplicate_count
from .profile import null_profile

# ---------------------------------------------------------------------------
# FIXED VALUES — the loan-table quirks of the audited workflow.
# ---------------------------------------------------------------------------
# Sentinel value meaning "unknown" per column (replaced by NULL before abs).
DEFAULT_SENTINELS = {"DAYS_EMPLOYED": 365243}
# Signed day-count columns made positive.
DEFAULT_ABS = ["DAYS_BIRTH", "DAYS_EMPLOYED"]
# Derived age: (source days column, new column, days per year, decimals).
DEFAULT_AGE = ("DAYS_BIRTH", "AGE_YEARS", 365.25, 1)
# Missing-fraction threshold above which a column is dropped.
MISSING_THRESHOLD = 0.45
# ---------------------------------------------------------------------------


def high_missing_columns(df: DataFrame, threshold: float = MISSING_THRESHOLD, protect=()) -> list[tuple]:
    """``[(column, null_frac)]`` with ``null_frac > threshold`` (strict), protected columns kept."""
    prof = null_profile(df).collect()                      # one row per column
    keep = set(c for c in protect if c)
    return [(r["column"], r["pct_missing"] / 100.0) for r in prof
            if r["pct_missing"] is not None and r["pct_missing"] / 100.0 > threshold and r["column"] not in keep]


def fix_quirks(df: DataFrame, sentinels=None, abs_cols=None, age=DEFAULT_AGE):
    """Sentinel → NULL (before abs), abs of day counts, derived age in years.

    Only columns that exist are touched.  Returns ``(df, counts)`` where counts is
    a one-row DataFrame of replaced sentinels per column.
    """
    sentinels = DEFAULT_SENTINELS if sentinels is None else sentinels
    abs_cols = DEFAULT_ABS if abs_cols is None else abs_cols
    present = {c: v for c, v in sentinels.items() if c in df.columns}
    counts = df.agg(*[F.count(F.when(F.col(c) == v, 1)).alias(c) for c, v in present.items()]) if present else None
    out = df
    for c, v in present.items():
        out = out.withColumn(c, F.when(F.col(c) != v, F.col(c)))
    for c in abs_cols:
        if c in out.columns:
            out = out.withColumn(c, F.abs(c))
    if age and age[0] in out.columns:
        src, name, per_year, digits = age
        out = out.withColumn(name, F.round(F.abs(F.col(src)) / per_year, digits))
    return out, counts


def drop_null_rows(df: DataFrame, subset) -> DataFrame:
    """Rows without a NULL (or NaN) in any of the ``subset`` columns that exist."""
    return df.dropna(subset=[c for c in subset if c in df.columns])


def clean(df: DataFrame, protect=(), threshold: float = MISSING_THRESHOLD, sentinels=None,
          abs_cols=None, age=DEFAULT_AGE, dedup: bool = True, keep=()):
    """Returns ``(clean_df, log_df)``; log rows are ``step, column, value``: the columns dropped as mostly missing
    (share), the number of duplicate rows and of sentinels per column (where there are any), the columns dropped as
    not numeric.  ``keep`` columns stay whatever their type and share of NULLs."""
    spark = df.sparkSession
    dropped = high_missing_columns(df, threshold, [*protect, *keep])
    out = df.drop(*[c for c, _ in dropped])
    log = [("drop_missing", c, float(f)) for c, f in dropped]
    if dedup:
        n = duplicate_count(out).first()["exact_dupes"]
        if n:
            log.append(("drop_duplicates", None, float(n)))
            out = drop_duplicates(out)
    out, counts = fix_quirks(out, sentinels, abs_cols, age)
    if counts is not None:
        log += [("sentinel", c, float(n)) for c, n in sorted(counts.first().asDict().items()) if n]
    numeric = [f.name for f in out.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) or f.name in keep]
    removed = [c for c in out.columns if c not in numeric]
    log += [("drop_non_numeric", c, None) for c in removed]
    out = out.select(*numeric)
    return out, spark.createDataFrame(log, "step string, column string, value double")
