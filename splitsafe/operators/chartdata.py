"""The tables behind the audit's charts (L1-L11) and the experiment summary.

Pixels are not produced; each chart's data is an ordinary DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tiers
from ..functions.numeric import as_double, round_half_even
from .profile import slot_names, stack_columns


def histogram(df: DataFrame, features, by: str | None, bins: int = 50, density: bool = True) -> DataFrame:
    """Per feature (and class) ``bins`` equal-width bins over that slice's own
    min..max (``lo == hi`` widened by ±0.5), with counts and density ``c / (n·width)``.

    Two aggregates: min/max/count per (feature, class), then counts per bin; the
    bin edges come from the first through a join on (feature, class) — a table
    with one row per slice.
    """
    features = list(features)
    keys = [by] if by else []
    vals = {c: as_double(df, c) for c in features}
    long = stack_columns(df, vals, keep=keys).where(F.col("x").isNotNull())
    g = ["__slot"] + keys
    rng = long.groupBy(*g).agg(F.min("x").alias("lo0"), F.max("x").alias("hi0"), F.count(F.lit(1)).alias("n"))
    rng = rng.select(*g, "n",
                     F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                     F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    j = long.join(F.broadcast(rng), g, "inner")
    b = F.least(F.floor((F.col("x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))), F.lit(bins - 1)).cast("int")
    counts = j.groupBy(*g, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    # every bin of every slice, generated per slice row (no product join)
    full = (rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
            .join(counts, g + ["bin"], "left"))
    width = (F.col("hi") - F.col("lo")) / bins
    out = full.select(slot_names(vals).alias("feature"), *keys, "bin",
                      (F.col("lo") + F.col("bin") * width).alias("edge_lo"),
                      (F.col("lo") + (F.col("bin") + 1) * width).alias("edge_hi"),
                      F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
                      (F.coalesce(F.col("count"), F.lit(0)) / (F.col("n") * width)).alias("density"))
    return out if density else out.drop("density")


def copy_counts(df: DataFrame, copy_col: str = "copy_no") -> DataFrame:
    """Original vs injected rows."""
    return df.groupBy(copy_col).agg(F.count(F.lit(1)).alias("n"))


def experiment_table(results: DataFrame) -> DataFrame:
    """Inflation, both severity scales, the expected shortfall and AUC reading.

    ``results`` has ``sin, name, honest_auc, leaky_auc``.
    """
    r = results.withColumn("inflation", F.col("leaky_auc") - F.col("honest_auc"))
    pct = F.regexp_replace(F.format_number(round_half_even(F.col("inflation") * 100, 1), 1), ",", "")
    return r.select("sin", "name", "honest_auc", "leaky_auc", "inflation",
                    tiers.inflation_severity("inflation").alias("severity"),
                    tiers.gauge_severity("inflation").alias("gauge_severity"),
                    tiers.auc_interpretation("leaky_auc").alias("leaky_reading"),
                    tiers.auc_interpretation("honest_auc").alias("honest_reading"),
                    tiers.auc_guide("leaky_auc").alias("leaky_guide"),
                    F.format_string(tiers.MSG_SHORTFALL, pct).alias("shortfall"))


def worst_experiment(results: DataFrame) -> DataFrame:
    """The experiment with the largest inflation (ties: lowest number)."""
    r = results.withColumn("inflation", F.col("leaky_auc") - F.col("honest_auc"))
    best = r.agg(F.max_by(F.struct("sin", "name", "inflation"),
                          F.struct(F.col("inflation"), -F.col("sin"))).alias("w"))
    return best.select("w.sin", "w.name", "w.inflation")
