"""Exact ROC AUC (K2, J10) and ROC curve points (L11), distributed.

AUC = Σ_s pos(s) · (neg_below(s) + neg(s)/2) / (P · N) over distinct scores s —
the Mann-Whitney statistic with ties counted half, identical to the rank formula.

Plan: (1) ``groupBy(by, score)`` with map-side partial counts, so a score value
shared by a third of all rows becomes one row; (2) a quantile sketch of each group's
distinct scores gives cut points, as many as the number of scores asks for, and a score's
bucket is a pure function of them: whichever task computes it, and however often, it gets
the same bucket, so nothing is written; (3) negatives per bucket → a prefix over the
buckets; (4) a window partitioned by ``(by, bucket)`` finishes the prefix inside each
bucket.  No task sees more than about one bucket's distinct scores; groups of up to
``BUCKET_SCORES`` scores have one bucket and need no sketch.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SCORES = 200_000     # distinct scores a bucket
MAX_CUTS = 5_000            # cut points of a group; larger buckets beyond a billion distinct scores


def _score_counts(df: DataFrame, score: str, label: str, by) -> DataFrame:
    y = F.col(label)
    return (df.where(F.col(score).isNotNull() & y.isNotNull())
            .groupBy(*by, F.col(score).cast("double").alias("score"))
            .agg(F.sum(F.when(y == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
                 F.sum(F.when(y == 1, 0).otherwise(1)).cast("bigint").alias("neg")))


def _bucketed(sc: DataFrame, by, bucket_scores: int) -> DataFrame | None:
    """``sc`` with the ``bucket`` of each score: how many of its group's cut points lie below it.
    None where no group has more scores than a bucket holds."""
    sizes = sc.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    most = sizes.agg(F.max("__n")).first()[0] or 0
    if most <= bucket_scores:
        return None
    n = min(-(-most // bucket_scores), MAX_CUTS)
    steps = F.array(*[F.lit(i / n) for i in range(1, n)])
    cuts = sc.groupBy(*by).agg(F.array_sort(F.array_distinct(F.percentile_approx("score", steps, 20 * n))).alias("__cuts"))
    if not by:
        held = cuts.first()["__cuts"]                # one row of at most MAX_CUTS numbers
        return sc.withColumn("bucket", _below(F.lit(held)))
    same = [F.col(b).eqNullSafe(F.col(f"__b{i}")) for i, b in enumerate(by)]
    j = sc.join(cuts.withColumnsRenamed({b: f"__b{i}" for i, b in enumerate(by)}), reduce(and_, same), "left")
    return j.withColumn("bucket", _below(F.col("__cuts"))).drop("__cuts", *[f"__b{i}" for i in range(len(by))])


def _below(cuts: F.Column) -> F.Column:
    """Number of ``cuts`` (ascending) below the score, by bisection."""
    lo_hi = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))

    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        right = (s["lo"] < s["hi"]) & (F.get(cuts, mid) < F.col("score"))
        return F.struct(F.when(right, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when((s["lo"] < s["hi"]) & ~right, mid).otherwise(s["hi"]).alias("hi"))

    rounds = F.array(*[F.lit(i) for i in range(MAX_CUTS.bit_length())])
    return F.aggregate(rounds, lo_hi, halve, lambda s: s["lo"])


def cumulative_counts(df: DataFrame, score: str, label: str, by=(), bucket_scores: int = BUCKET_SCORES) -> DataFrame:
    """Per distinct score: ``by..., score, pos, neg, neg_below, pos_above``.

    ``neg_below`` = negatives with a strictly smaller score, ``pos_above`` =
    positives with a strictly larger score (both exact).
    """
    by = list(by)
    sc = _score_counts(df, score, label, by)
    ranged = _bucketed(sc, by, bucket_scores)
    if ranged is None:
        whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        w = whole.orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
        return sc.select(*by, "score", "pos", "neg", (F.sum("neg").over(w) - F.col("neg")).alias("neg_below"),
                         (F.sum("pos").over(whole) - F.sum("pos").over(w)).alias("pos_above"))
    tot = ranged.groupBy(*by, "bucket").agg(F.sum("neg").alias("bneg"), F.sum("pos").alias("bpos"))
    wb = Window.partitionBy(*by).orderBy("bucket") if by else Window.orderBy("bucket")
    # ``tot`` has at most MAX_CUTS + 1 rows per group: a window over it is bounded
    tot = tot.select(*by, "bucket",
                     F.coalesce(F.sum("bneg").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0)).alias("neg_before"),
                     F.coalesce(F.sum("bpos").over(wb.rowsBetween(1, Window.unboundedFollowing)),
                                F.lit(0)).alias("pos_after"), "bpos")
    keys = by + ["bucket"]
    tot = tot.withColumnsRenamed({k: f"__t{i}" for i, k in enumerate(keys)})
    j = ranged.join(tot, reduce(and_, [F.col(k).eqNullSafe(F.col(f"__t{i}")) for i, k in enumerate(keys)]), "inner")
    w = Window.partitionBy(*by, "bucket").orderBy("score")
    return j.select(
        *by, "score", "pos", "neg",
        (F.col("neg_before") + F.coalesce(F.sum("neg").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                          F.lit(0))).alias("neg_below"),
        # a running sum: a frame that ends at the last row would be summed anew for each row
        (F.col("pos_after") + F.col("bpos")
         - F.sum("pos").over(w.rowsBetween(Window.unboundedPreceding, 0))).alias("pos_above"))


def roc_auc(df: DataFrame, score: str, label: str, by=(), **kw) -> DataFrame:
    """``by..., auc, n_pos, n_neg``; AUC is NULL when only one class is present."""
    by = list(by)
    cc = cumulative_counts(df, score, label, by, **kw)
    agg = cc.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)).alias("num"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return agg.select(*by, F.try_divide(F.col("num"), F.col("n_pos") * F.col("n_neg") * 1.0).alias("auc"),
                      "n_pos", "n_neg")


def roc_points(df: DataFrame, score: str, label: str, n_points: int = 100, by=(), **kw) -> DataFrame:
    """ROC curve sampled on a regular FPR grid: for each ``g/n_points`` the best TPR
    reachable with FPR ≤ that value.  ``by..., fpr, tpr`` with ``n_points + 1`` rows."""
    by = list(by)
    cc = cumulative_counts(df, score, label, by, **kw)
    tot = cc.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    # threshold at score s (predict positive when score >= s)
    if by:
        pts = cc.join(tot, by, "inner")
    else:
        pts = cc.select("*", tot.select("P").scalar().alias("P"), tot.select("N").scalar().alias("N"))
    tp = F.col("pos_above") + F.col("pos")
    fp = F.col("N") - F.col("neg_below")
    pts = pts.select(*by, fp.alias("fp"), F.col("N"),
                     F.try_divide(tp * 1.0, F.col("P")).alias("tpr"))
    # grid cell g holds points with (g-1)/n < fpr <= g/n, in exact integer arithmetic
    grid_cell = F.expr(f"CAST((fp * {int(n_points)} + N - 1) div N AS INT)")
    best = pts.groupBy(*by, grid_cell.alias("g")).agg(F.max("tpr").alias("tpr"))
    if by:
        grid = tot.select(*by, F.explode(F.sequence(F.lit(0), F.lit(n_points))).alias("g"))
    else:
        grid = df.sparkSession.range(0, n_points + 1).select(F.col("id").cast("int").alias("g"))
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))).orderBy("g") \
        .rowsBetween(Window.unboundedPreceding, 0)
    out = grid.join(best, by + ["g"], "left").select(
        *by, (F.col("g") / float(n_points)).alias("fpr"),
        F.coalesce(F.max("tpr").over(w), F.lit(0.0)).alias("tpr"))
    return out
