"""Fault injectors (H4-H6, F9): DataFrame → DataFrame, deterministic per row key.

They reproduce the data faults the audit demonstrates, so a user can measure
how sensitive their own table and split are.  Appended rows carry
``copy_no = 1`` (originals 0); ``(row_key, copy_no)`` stays unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import gaussian
from .split import in_sample, sample_rows, sample_threshold


def inject_duplicates(df: DataFrame, key: str, frac: float = 0.08, seed: int = 42,
                      copy_col: str = "copy_no", **kw) -> DataFrame:
    """H4: append an exact copy of ``int(n * frac)`` rows chosen by hash (no replacement)."""
    base = df.withColumn(copy_col, F.lit(0))
    picked = sample_rows(df, key, frac=frac, seed=seed, **kw).withColumn(copy_col, F.lit(1))
    return base.unionByName(picked)


def inject_group_overlap(df: DataFrame, group: str, key: str, features, frac: float = 0.30,
                         noise_std: float = 0.05, seed: int = 42, copy_col: str = "copy_no",
                         **kw) -> DataFrame:
    """H5: every row of ``int(n_groups * frac)`` sampled groups is appended again with
    N(0, noise_std) noise on each feature; label and group are kept, so the same
    entity now sits on both sides of a row-level split."""
    groups = df.where(F.col(group).isNotNull()).select(group).distinct()
    thr = sample_threshold(groups, group, frac=frac, seed=seed, **kw)
    rows = df.where(F.col(group).isNotNull() & in_sample(df, group, thr, seed))   # no join: a hash test
    noisy = rows.select(*[
        (F.col(c) + gaussian(seed, 0.0, noise_std, F.col(key), F.lit(c))).alias(c) if c in features
        else F.col(c) for c in df.columns])
    return df.withColumn(copy_col, F.lit(0)).unionByName(noisy.withColumn(copy_col, F.lit(1)))


def inject_target_feature(df: DataFrame, target: str, key: str, name: str = "SYNTHETIC_RISK_SCORE",
                          seed: int = 42, pos=(0.80, 0.15), neg=(0.20, 0.15)) -> DataFrame:
    """H6: a post-outcome feature, N(0.8, 0.15) for positives and N(0.2, 0.15) for
    negatives, clipped to [0, 1]."""
    y = F.col(target)
    v = F.when(y == 1, gaussian(seed, pos[0], pos[1], F.col(key))) \
         .otherwise(gaussian(seed, neg[0], neg[1], F.col(key)))
    return df.withColumn(name, F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)))


def dedup_effect(injected: DataFrame, features, target: str, copy_col: str = "copy_no") -> DataFrame:
    """Q4: what de-duplicating on features + target removes after an injection — the
    injected copies and any genuine look-alike rows.  One row:
    ``n_rows, n_injected, n_after_dedup, n_removed, n_removed_original``."""
    cols = list(features) + [target]
    per = injected.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"),
                                      F.sum(F.col(copy_col)).alias("__inj"))
    # a group keeps one row; removed originals = rows removed beyond the injected copies
    return per.agg(
        F.sum("__n").cast("bigint").alias("n_rows"),
        F.sum("__inj").cast("bigint").alias("n_injected"),
        F.count(F.lit(1)).alias("n_after_dedup"),
        F.sum(F.col("__n") - 1).cast("bigint").alias("n_removed"),
        F.sum(F.greatest(F.col("__n") - 1 - F.col("__inj"), F.lit(0))).cast("bigint").alias("n_removed_original"))
