"""Fits of every fold's complement in one pass (J13, J4, J6): the rows outside fold f train fold f's model.

Moments are aggregated per (feature, fold) and merged over the other folds, without a subtraction. The medians of
all complements come from one histogram table with a count per fold: each value lies in one bucket whatever
fold is left out, so no row is repeated per fold. The first histogram has buckets of equal width, whose number is plain
arithmetic. The passes behind it read only the values in the buckets that hold some complement's median, cut at
quantiles; where equal widths leave many of them (heavy tails), those cuts share them out.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.numeric import as_double
from .profile import stack_columns

BUCKETS = 1024          # equal widths of the first histogram
CUTS = 64
EVERY_ROW = None        # the complement of no fold


def _merged(parts):
    """(rows, values, mean, sum of squared deviations) of several disjoint sets of rows."""
    n = nn = 0
    mean = m2 = 0.0
    for r in parts:
        n += r["n"]
        if r["nn"]:
            d, both = r["mean"] - mean, nn + r["nn"]
            m2 += r["var"] * r["nn"] + d * d * nn * r["nn"] / both
            mean += d * r["nn"] / both
            nn = both
    return n, nn, mean, m2


def _cut_points(column="x"):
    return F.percentile_approx(column, F.array(*[F.lit(i / CUTS) for i in range(CUTS + 1)]), 10_000)


def _thinned(values) -> list[float]:
    values = sorted(set(values))
    step = max(1, -(-len(values) // (2 * CUTS)))
    return sorted({*values[::step], values[-1]})


def _narrow(values: DataFrame, ranges: dict, targets: list[dict]) -> DataFrame:
    """The values in the open ``ranges`` {(slot, range): (lo, hi, cuts)}, with their bucket; moves ``targets`` to their buckets.

    Buckets: of equal width without cuts; else an even one between two cuts, an odd one for values equal to a cut.
    Ranges of a slot are disjoint.
    """
    spark = values.sparkSession
    rows = spark.createDataFrame([(*k, *v) for k, v in ranges.items()], "__slot int, rng int, lo double, hi double, cuts array<double>")
    even = f"least(cast((x - lo) / (hi - lo) * {BUCKETS} as int), {BUCKETS - 1})"
    cut = "2 * size(filter(cuts, c -> c < x)) + if(array_contains(cuts, x), 1, 0)"
    widths = {c is None for _, _, c in ranges.values()}
    bucket = F.expr(even if widths == {True} else cut if widths == {False} else f"if(cuts is null, {even}, {cut})")
    inside = (values.join(F.broadcast(rows), "__slot").where("x >= lo and x <= hi")
              .select("__slot", "rng", "fold", "x", bucket.alias("b")))
    counts = (inside.groupBy("__slot", "rng", "b", "fold").agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))
              .groupBy("__slot", "rng", "b").agg(F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                                 F.map_from_entries(F.collect_list(F.when(F.col("fold").isNotNull(), F.struct("fold", "c")))).alias("of")))
    want = spark.createDataFrame([(i, t["slot"], t["rng"], t["out"], t["k"] - t["below"]) for i, t in enumerate(targets) if t["rng"] is not None],
                                 "t int, __slot int, rng int, out int, k long")
    own = counts.join(F.broadcast(want), ["__slot", "rng"]).withColumn("c", F.col("c") - F.coalesce(F.try_element_at("of", "out"), F.lit(0)))
    w = Window.partitionBy("t").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)      # a row a bucket
    own = own.withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0)))
    for r in own.where("before <= k and k < before + c").select("t", "b", "lo", "hi", "before").collect():
        t = targets[r["t"]]
        t.update(below=t["below"] + r["before"], lo=r["lo"], hi=r["hi"], rng=(t["rng"], r["b"]))
    return inside


def fold_fit_stats(df: DataFrame, features, fold_col: str, whole: bool = False) -> DataFrame:
    """``fold, feature, n, n_null, median, mean, std_pop`` of the rows outside each fold (an integer; rows without
    one are outside every fold). ``whole`` adds the fit of all rows, with fold NULL. As :func:`fit.fit_stats` on each
    complement; features without a value there have NULL statistics. An empty table gives no rows. The driver holds
    one row per feature and fold, and the cut points of the ranges still open."""
    features, spark = list(features), df.sparkSession
    src = df.select(F.col(fold_col).cast("int").alias("fold"), *[as_double(df, c).alias(f"f{i}") for i, c in enumerate(features)])
    long = stack_columns(src, {c: F.col(f"f{i}") for i, c in enumerate(features)}, keep=["fold"])
    first = long.groupBy("__slot", "fold").agg(
        F.count(F.lit(1)).alias("n"), F.count("x").alias("nn"), F.avg("x").alias("mean"), F.var_pop("x").alias("var"),
        F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    folds = sorted({r["fold"] for r in first if r["fold"] is not None})
    parts, fits, targets, ranges = {}, [], [], {}
    for r in first:
        parts.setdefault(r["__slot"], []).append(r)
    for slot, rows in sorted(parts.items()):
        full = [r for r in rows if r["nn"]]
        if full:
            lo, hi = min(r["lo"] for r in full), max(r["hi"] for r in full)
            ranges[slot, 0] = (lo, hi, None if 0 < hi - lo < math.inf else [lo, hi])
        for out in [*folds, *([EVERY_ROW] if whole else [])]:
            n, nn, mean, m2 = _merged([r for r in rows if out is EVERY_ROW or r["fold"] != out])
            middle = [{"slot": slot, "rng": 0, "out": out, "k": k, "below": 0} for k in sorted({(nn - 1) // 2, nn // 2})] if nn else []
            targets += middle
            fits.append((slot, out, n, nn, mean, m2, middle))
    values, held = long.where("x is not null"), None
    endless = [slot for (slot, _), r in ranges.items() if r[0] < r[1] and r[2]]      # an infinite end: no widths
    if endless:
        for r in values.where(F.col("__slot").isin(endless)).groupBy("__slot").agg(_cut_points().alias("cuts")).collect():
            lo, hi, _ = ranges[r["__slot"], 0]
            ranges[r["__slot"], 0] = (lo, hi, _thinned([lo, hi, *r["cuts"]]))
    try:
        while ranges:
            inside = _narrow(values, ranges, targets)
            # the buckets that hold a rank and more than one value are the next ranges
            chosen = sorted({(t["slot"], *t["rng"], t["lo"], t["hi"]) for t in targets if isinstance(t["rng"], tuple) and t["lo"] < t["hi"]})
            place = {c: i for i, c in enumerate(chosen)}
            for t in targets:
                if t["rng"] is not None:
                    t["rng"] = place.get((t["slot"], *t["rng"], t["lo"], t["hi"]))
            if not chosen:
                break
            rows = spark.createDataFrame([(c[0], c[1], c[2], i) for c, i in place.items()], "__slot int, rng int, b int, next int")
            values = inside.join(F.broadcast(rows), ["__slot", "rng", "b"]).select("__slot", "fold", "x", F.col("next").alias("own"))
            if held is None:
                held = values = values.persist(StorageLevel.MEMORY_AND_DISK)
            cuts = {r["own"]: r["cuts"] for r in values.groupBy("own").agg(_cut_points().alias("cuts")).collect()}
            ranges = {(c[0], i): (c[3], c[4], _thinned([c[3], c[4], *cuts[i]])) for c, i in place.items()}
            values = values.select("__slot", "fold", "x")
    finally:
        if held is not None:
            held.unpersist()
    rows = []
    for slot, out, n, nn, mean, m2, middle in fits:
        if not nn:
            rows.append((out, features[slot], n, n, None, None, None))
            continue
        median = sum(t["lo"] for t in middle) / len(middle)
        d, nb = median - mean, n - nn
        rows.append((out, features[slot], n, nb, median, mean + d * nb / n, math.sqrt(max(m2 + d * d * nn * nb / n, 0.0) / n)))
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("fold", T.IntegerType()), T.StructField("feature", T.StringType()), T.StructField("n", T.LongType()),
        T.StructField("n_null", T.LongType()), T.StructField("median", T.DoubleType()), T.StructField("mean", T.DoubleType()),
        T.StructField("std_pop", T.DoubleType())]))
