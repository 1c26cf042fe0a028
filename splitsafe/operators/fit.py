"""Fit tables (K3) for median imputation (J4) and standardisation (J5), and fit drift.

A fit is a long table ``feature, n, median, mean, std_pop`` computed on the rows
a split allows (train only for the honest arm, every row for the leaky one).
Medians are exact (K1 selection); mean and *population* std are taken over the
imputed values, as an imputer followed by a scaler would see them.  The fit
table has one row per feature, so it is applied as literals inside a single
``select`` (no join, stays in codegen).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import as_double
from .concurrent import run_concurrently
from .profile import stack_columns
from .rank import medians


def fit_stats(df: DataFrame, features, where=None, **kw) -> DataFrame:
    """``feature, n, n_null, median, mean, std_pop`` on the rows matching ``where``.

    Two independent jobs run concurrently: exact medians (K1) and the moments of
    the non-null values.  The moments of the *imputed* column (NULLs replaced by
    the median) then follow exactly from the parallel-variance combination of the
    non-null group with ``n_null`` copies of the median, so no third pass is needed.
    """
    features = list(features)
    src = df.where(where) if where is not None else df
    src = src.select(*[as_double(src, c).alias(c) for c in features])
    long = stack_columns(src, {c: F.col(c) for c in features})
    mom = long.groupBy("__slot").agg(F.count(F.lit(1)).alias("n"), F.count("x").alias("nn"),
                                     F.avg("x").alias("mean"), F.var_pop("x").alias("var"))
    med_rows, mom_rows = run_concurrently(lambda: medians(src, features, **kw).collect(), mom.collect)
    med = {r["column"]: r["median"] for r in med_rows}
    rows = []
    for r in mom_rows:
        c = features[r["__slot"]]
        n, nn, m = r["n"], r["nn"], med.get(c)
        if nn == 0 or m is None:
            rows.append((c, n, n - nn, None, None, None))
            continue
        nb = n - nn                                   # imputed cells, all equal to the median
        delta = m - r["mean"]
        mean = r["mean"] + delta * nb / n
        m2 = r["var"] * nn + delta * delta * nn * nb / n
        rows.append((c, n, nb, m, mean, math.sqrt(max(m2, 0.0) / n)))
    schema = "feature string, n bigint, n_null bigint, median double, mean double, std_pop double"
    order = {c: i for i, c in enumerate(features)}
    return df.sparkSession.createDataFrame(sorted(rows, key=lambda r: order[r[0]]), schema)


def apply_fit(df: DataFrame, fit: DataFrame | list, features=None, keep=()) -> DataFrame:
    """Impute with the fitted median, then ``(x - mean) / std`` (std 0 → scale 1).

    Features whose fitted median is NULL (all missing in the fit rows) are
    dropped, as an imputer does by default.
    """
    rows = fit.collect() if isinstance(fit, DataFrame) else fit
    stats = {r["feature"]: r for r in rows}
    feats = [f for f in (features or list(stats)) if stats[f]["median"] is not None]
    cols = []
    for f in feats:
        s = stats[f]
        x = F.coalesce(as_double(df, f), F.lit(float(s["median"])))
        std = s["std_pop"]
        scale = float(std) if std else 1.0        # a constant column is only centred
        cols.append(((x - F.lit(float(s["mean"]))) / F.lit(scale)).alias(f))
    return df.select(*[F.col(c) for c in keep], *cols)


def fit_drift(df: DataFrame, features, train_where) -> DataFrame:
    """Train-only vs all-row statistics per feature, in one pass: the quantity behind leak 3."""
    from .complement import fold_fit_stats
    held = F.when(train_where, F.lit(0)).otherwise(F.lit(1)).alias("__held")
    both = fold_fit_stats(df.select(*features, held), features, "__held", whole=True)     # the train rows are those outside fold 1
    tr, al = both.where("fold = 1"), both.where("fold is null")
    if not tr.limit(1).count():         # no row is held out
        tr = al
    t = tr.select("feature", *[F.col(c).alias(f"{c}_train") for c in ("median", "mean", "std_pop")])
    a = al.select("feature", *[F.col(c).alias(f"{c}_all") for c in ("median", "mean", "std_pop")])
    j = t.join(a, "feature")
    return j.withColumn("mean_shift_sd", F.try_divide(F.col("mean_all") - F.col("mean_train"), F.col("std_pop_train"))) \
            .withColumn("std_ratio", F.try_divide(F.col("std_pop_all"), F.col("std_pop_train")))
