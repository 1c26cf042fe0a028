"""Scalar numeric helpers that stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, digits: int) -> Column:
    """numpy/pandas ``round``: ``rint(x * 10**d) / 10**d`` (Spark's ``round`` is half-up)."""
    scale = float(10 ** digits)
    return F.rint(col_(c) * F.lit(scale)) / F.lit(scale)


def round6(c) -> Column:
    """Stable 6-decimal rounding used on every float that leaves a registered query.

    ``floor(x * 1e6 + 0.5) / 1e6`` is plain IEEE arithmetic, so Spark and DuckDB give
    the same double for the same input.
    """
    return (F.floor(col_(c).cast("double") * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6))


def sql_round6(expr: str) -> str:
    return f"(floor(({expr})::DOUBLE * 1e6 + 0.5) / 1e6)"


def nan_to_null(c) -> Column:
    """NaN is missing (pandas semantics); Spark's corr/median would treat it as a value."""
    x = col_(c)
    return F.when(~F.isnan(x), x)


def as_double(df, name: str) -> Column:
    """Feature value as DOUBLE with NaN normalised to NULL (NaN only exists for float types)."""
    dt = df.schema[name].dataType
    x = F.col(name).cast("double")
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(x), x)
    return x


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson correlation, pairwise complete, NULL when either side is constant.

    ``F.corr`` raises DIVIDE_BY_ZERO under ANSI mode for a constant column; pandas
    returns NaN there.  Both inputs are masked together so that the standard
    deviations are taken over the same rows as the covariance.
    """
    both = x.isNotNull() & y.isNotNull()
    xm = F.when(both, x)
    ym = F.when(both, y)
    denom = F.stddev_pop(xm) * F.stddev_pop(ym)
    r = F.try_divide(F.covar_pop(xm, ym), F.when(denom > 0, denom))
    # rounding can step past ±1; greatest/least skip NULLs, so keep NULL (constant column) NULL
    return F.when(r.isNotNull(), F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0)))


def sql_guarded_corr(x: str, y: str) -> str:
    both = f"({x}) IS NOT NULL AND ({y}) IS NOT NULL"
    xm = f"CASE WHEN {both} THEN ({x}) END"
    ym = f"CASE WHEN {both} THEN ({y}) END"
    r = (f"covar_pop({xm}, {ym}) / NULLIF(CASE WHEN stddev_pop({xm}) * stddev_pop({ym}) > 0 "
         f"THEN stddev_pop({xm}) * stddev_pop({ym}) END, 0)")
    return f"CASE WHEN ({r}) IS NOT NULL THEN least(greatest({r}, -1.0), 1.0) END"
