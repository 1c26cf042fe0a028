"""Deterministic splits and samples as columns on one DataFrame (F1-F8).

A split is a ``split ∈ {'train','test'}`` column and k-fold is a ``fold``
column — never copies of the table.  All randomness is the md5 hash of
``seed:row_key`` (K4), so a split does not move when the plan or the
partitioning changes, and both arms of an experiment see the same split.
The hash key must be the *unique row key*: hashing row content would send both
copies of a duplicate to the same side and hide leaks 4 and 5.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_int
from .rank import at_or_before, composite_threshold, order_parts


COPIES_AT_ONCE = 100_000


def with_row_key(df: DataFrame, id_col: str | None = None, name: str = "row_key") -> DataFrame:
    """Attach a unique row key (the audited workflow relied on the in-memory index).

    The id itself when it is unique (one aggregate checks it); otherwise text made of the row's 128-bit content key
    and the number of the copy among rows equal in every column.  Only rows whose content key repeats are exchanged;
    equal rows collapse to one in the partial aggregate and are numbered as they are written out again, so that a row
    that a third of the table holds is no burden.  The key depends on the rows alone: recomputation, another order or
    another partitioning gives the same (row, key) pairs, and nothing but repeated content keys is written.
    """
    from .duplicates import _maybe_repeated, _repeated_keys
    if id_col is not None:
        dup = (df.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").limit(1).count()
               + df.where(F.col(id_col).isNull()).limit(1).count())
        if dup == 0:
            return df.withColumn(name, F.col(id_col))
    cols = list(df.columns)
    content = F.concat(F.lower(F.hex("__h1")), F.lit(":"), F.lower(F.hex("__h2")), F.lit("#"))
    keys, n = _repeated_keys(df, cols)
    flagged = _maybe_repeated(df, cols, keys, n)
    once = flagged.where("not __maybe").select(*cols, F.concat(content, F.lit("0")).alias(name))
    if not n:
        return once
    groups = flagged.where("__maybe").groupBy(*cols, "__h1", "__h2").agg(F.count(F.lit(1)).alias("__n"))
    parts = groups.withColumn("__part", F.explode(F.expr(f"sequence(0L, (__n - 1) div {COPIES_AT_ONCE})")))
    parts = parts.repartition("__h1", "__h2", "__part")
    first = f"__part * {COPIES_AT_ONCE}"
    copies = parts.withColumn("__copy", F.explode(F.expr(f"sequence({first}, least({first} + {COPIES_AT_ONCE}, __n) - 1)")))
    return once.unionByName(copies.select(*cols, F.concat(content, F.col("__copy").cast("string")).alias(name)))


def _tiebreak(df: DataFrame, key: str, seed) -> tuple[DataFrame, str]:
    """Order within equal hashes: the key itself when numeric, else a second hash of it."""
    from pyspark.sql import types as T
    if isinstance(df.schema[key].dataType, (T.StringType, T.BinaryType)):
        return df.withColumn("__h2", hash_int(f"{seed}~", key).cast("double")), "__h2"
    return df, key


def allocate_stratified(class_counts: dict, test_size: float) -> dict:
    """Per-class test counts of an exact stratified split.

    Total test rows ``ceil(test_size * n)``; the train rows are shared out by
    largest remainder of ``n_c * n_train / n`` (ties: the smaller class first,
    then the smaller label), and each class's test count is what remains.
    """
    n = sum(class_counts.values())
    if n == 0:
        return {c: 0 for c in class_counts}
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    cont = {c: v * n_train / n for c, v in class_counts.items()}
    floor = {c: math.floor(x) for c, x in cont.items()}
    extra = n_train - sum(floor.values())
    order = sorted(class_counts, key=lambda c: (-(cont[c] - floor[c]), class_counts[c], str(c)))
    for c in order[:extra]:
        floor[c] += 1
    return {c: class_counts[c] - floor[c] for c in class_counts}


def stratified_split(df: DataFrame, target: str, key: str, test_size: float = 0.2,
                     seed: int = 42, exact: bool = True, col: str = "split", **kw) -> DataFrame:
    """F2 (and F1, which is the same operation): stratified train/test column.

    ``exact=True``: each class's first ``t_c`` rows in ``(h(seed:key), key)`` order
    are test, with ``t_c`` from :func:`allocate_stratified`; the cut per class is
    found by :func:`~splitsafe.operators.rank.composite_threshold` (no global sort).
    ``exact=False``: one pass, ``h / 2**32 < test_size`` (counts are then binomial).
    Rows with a NULL target get a NULL split.
    """
    h = hash_int(seed, key)          # 32 bits: exact as a double
    if not exact:
        return df.withColumn(col, F.when(F.col(target).isNotNull(),
                                         F.when(h < F.lit(test_size * 4294967296.0), "test")
                                         .otherwise("train")))
    def ranks(counts):               # class counts come from the selection's own first pass
        alloc = allocate_stratified({k[0]: n for k, n in counts.items()}, test_size)
        return [{target: c, "k": int(t) - 1} for c, t in alloc.items() if t > 0]

    hashed, tie = _tiebreak(df.where(F.col(target).isNotNull()).withColumn("__h", h.cast("double")), key, seed)
    thr = composite_threshold(hashed, ["__h", tie], ranks, [target], **kw)
    hashed, _ = _tiebreak(df.withColumn("__h", h.cast("double")), key, seed)
    out = hashed.join(F.broadcast(thr.drop("k")), target, "left")
    is_test = F.col("t0").isNotNull() & at_or_before(out, ["__h", tie])
    out = out.withColumn(col, F.when(F.col(target).isNotNull(),
                                     F.when(is_test, "test").otherwise("train")))
    return out.drop("__h", "__h2", *[c for c in thr.columns if c not in (target, "k")])


random_split = stratified_split


def hash_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42,
               col: str = "split", buckets: int = 10) -> DataFrame:
    """Unstratified one-pass split: ``h mod buckets < round(test_size * buckets)`` is test."""
    cut = int(round(test_size * buckets))
    return df.withColumn(col, F.when(F.pmod(hash_int(seed, key), F.lit(buckets)) < cut, "test")
                         .otherwise("train"))


def deal_largest_first(counts: dict[int, int], k: int) -> dict[int, list[int]]:
    """How many of the ``counts[size]`` groups of each size every one of ``k`` folds gets when groups, largest first,
    go one by one to the fold with the fewest rows (ties: the lower fold).

    Groups of one size are dealt at once: the fold with ``load`` takes them at loads ``load, load + size, ...``, and
    the greedy rule serves the least of all these values first."""
    loads, out = [0] * k, {}
    for size in sorted(counts, reverse=True):
        n = counts[size]

        def taken(top):     # groups that go to each fold at loads below ``top``
            return [max(0, -(-(top - x) // size)) for x in loads]

        lo, hi = min(loads), max(loads) + size * (n // k + 2)
        while hi - lo > 1:  # the greatest ``lo`` below which no more than n are taken
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if sum(taken(mid)) <= n else (lo, mid)
        own = taken(lo)
        left = n - sum(own)
        for f in range(k):  # the rest goes to folds whose next group would begin at ``lo`` exactly
            if left and loads[f] + own[f] * size == lo:
                own[f] += 1
                left -= 1
        out[size] = own
        loads = [x + m * size for x, m in zip(loads, own)]
    return out


def _largest_first_folds(groups: DataFrame, group: str, k: int, n_buckets: int, col: str) -> DataFrame:
    """group → fold of :func:`deal_largest_first`. The driver holds a row a distinct size: at most sqrt(2 n) for n rows.
    In the order of their hashes, the groups of a size fill one fold's share after the other; the rank is a prefix sum
    over hash ranges plus the place inside one, so that no task holds a whole class."""
    part = (F.col("__h") * F.lit(n_buckets) / F.lit(4294967296.0)).cast("int")
    groups = groups.withColumn("__part", part)
    sizes = groups.groupBy("__size", "__part").agg(F.count(F.lit(1)).alias("__n"))
    deal = deal_largest_first({r["__size"]: r["n"] for r in sizes.groupBy("__size").agg(F.sum("__n").alias("n")).collect()}, k)
    spark = groups.sparkSession
    shares = spark.createDataFrame([(s, [sum(m[:f + 1]) for f in range(k)]) for s, m in deal.items()],
                                   "__size bigint, __ends array<bigint>")
    before = Window.partitionBy("__size").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n").join(shares, "__size")
    inside = Window.partitionBy("__size", "__part").orderBy("__h", group)
    ranked = groups.withColumn("__rn", F.row_number().over(inside)).join(base, ["__size", "__part"])
    return ranked.select(group, F.expr("cast(size(filter(__ends, e -> e < __base + __rn)) as int)").alias(col))


def group_kfold(df: DataFrame, group: str, k: int = 5, seed: int = 42, balanced: bool | str = False,
                n_buckets: int = 64, col: str = "fold") -> DataFrame:
    """every row of a group lands in one fold.

    Default: ``fold = h(seed:group) mod k`` — one narrow pass.  ``balanced=True``
    deals groups round-robin inside classes of equal group size (and a hash bucket
    of the group, so no class is one huge partition): one aggregate over groups,
    a window partitioned by (size, bucket) and a join back on the group key.
    ``balanced="largest_first"`` gives folds of exactly the sizes that dealing the groups one by one, the
    largest first, each to the smallest fold, gives (see :func:`deal_largest_first`).
    ``n_buckets`` is a parameter, never derived from the data, so the folds of existing
    groups don't move when the table grows; raise it for tables of very many groups.
    NULL groups form no group and get a NULL fold.
    """
    h = hash_int(seed, group)
    if not balanced:
        return df.withColumn(col, F.when(F.col(group).isNotNull(), F.pmod(h, F.lit(k)).cast("int")))
    groups = (df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("__size"))
              .withColumn("__h", h))
    if balanced == "largest_first":
        return df.join(_largest_first_folds(groups, group, k, n_buckets, col), group, "left")
    w = Window.partitionBy("__size", F.pmod(F.col("__h"), F.lit(n_buckets))).orderBy("__h", group)
    start = F.pmod(hash_int(seed, F.col("__size"), F.pmod(F.col("__h"), F.lit(n_buckets))), F.lit(k))
    folds = groups.select(group, F.pmod(F.row_number().over(w) - 1 + start, F.lit(k)).cast("int").alias(col))
    return df.join(folds, group, "left")


def temporal_split(df: DataFrame, order_by, frac: float = 0.8, col: str = "split", **kw) -> DataFrame:
    """the first ``int(n * frac)`` rows in ``order_by`` order are train ("past").

    The cut is one threshold tuple found by exact selection (its first pass also
    counts ``n``), applied as literals in a filter expression.  Rows with a NULL order
    value are neither past nor future: they get a NULL split and don't count.  Order columns may be
    numbers, decimals of any precision, dates, timestamps, booleans or text (byte order).
    """
    order_by = list(order_by)

    def ranks(counts):
        m = int(sum(counts.values()) * frac)
        return [{"k": m - 1}] if m > 0 else []

    known = reduce(and_, [F.col(c).isNotNull() for c in order_by])
    thr = composite_threshold(df.where(known), order_by, ranks, (), **kw).collect()   # at most one row
    if not thr:
        return df.withColumn(col, F.when(known, "test"))
    lits = {c: F.lit(v) for c, v in thr[0].asDict().items() if c != "k"}
    past = at_or_before(df, order_by, values=lits)
    return df.withColumn(col, F.when(known & past, "train").when(known, "test"))


def sample_threshold(df: DataFrame, key: str, frac: float | None = None, n: int | None = None,
                     seed: int = 42, **kw):
    """Threshold ``(t0, t1, ...)`` of an exact sample: a row is sampled iff
    ``(h(seed:key), tiebreak) <= (t0, t1, ...)``.  Returns ``None`` for an empty sample.

    The threshold is one row, so applying it is a filter against a broadcast
    constant — no join with the (data-sized) set of sampled keys.
    """
    hashed, tie = _tiebreak(df.withColumn("__h", hash_int(seed, key).cast("double")), key, seed)

    def ranks(counts):
        total = sum(counts.values())
        m = n if n is not None else int(total * frac)
        return [{"k": m - 1}] if m > 0 else []

    thr = composite_threshold(hashed, ["__h", tie], ranks, (), **kw).collect()
    return tuple(thr[0][1:]) if thr and thr[0]["t0"] is not None else None


def in_sample(df: DataFrame, key: str, thr, seed: int = 42) -> F.Column:
    """Boolean column: the row's key is inside the sample described by ``thr``."""
    if thr is None:
        return F.lit(False)
    from pyspark.sql import types as T
    tie = ([hash_int(f"{seed}~", key).cast("double")]
           if isinstance(df.schema[key].dataType, (T.StringType, T.BinaryType)) else order_parts(df, key))
    expr = F.coalesce(tie[-1] <= F.lit(thr[-1]), F.lit(True))
    for x, t in zip([hash_int(seed, key).cast("double"), *tie][-2::-1], thr[-2::-1]):
        t = F.lit(t)
        expr = (x < t) | ((x == t) & expr)
    return F.col(key).isNotNull() & expr


def sample_rows(df: DataFrame, key: str, frac: float | None = None, n: int | None = None,
                seed: int = 42, **kw) -> DataFrame:
    """exactly ``n`` (or ``int(N * frac)``) rows without replacement — the ones with
    the smallest ``(h(seed:key), key)``."""
    thr = sample_threshold(df, key, frac, n, seed, **kw)
    return df.where(in_sample(df, key, thr, seed))


def split_stats(df: DataFrame, target: str, col: str = "split") -> DataFrame:
    """Rows, share and class rate per side, and the balance verdict
    (train vs test rate differ by less than 0.5 percentage points)."""
    side = df.where(F.col(col).isNotNull())
    y = F.col(target).cast("double")
    per = side.groupBy(col).agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("target_rate"))
    tot = side.agg(F.count(F.lit(1)).alias("n"),
                   F.avg(F.when(F.col(col) == "train", y)).alias("tr"),
                   F.avg(F.when(F.col(col) == "test", y)).alias("te"))
    t = tot.select(F.struct("n", "tr", "te")).scalar()            # one scalar subquery
    return per.select(col, "n", (F.col("n") / t["n"]).alias("share"), "target_rate",
                      (F.abs(t["tr"] - t["te"]) * 100 < 0.5).alias("balanced"))


def group_overlap(df: DataFrame, group: str, col: str = "split") -> DataFrame:
    """Groups seen on both sides, in train, in test, in total — one groupBy, no join."""
    g = df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.max((F.col(col) == "train").cast("int")).alias("tr"),
        F.max((F.col(col) == "test").cast("int")).alias("te"))
    return g.agg(
        F.sum(F.col("tr") * F.col("te")).cast("bigint").alias("n_both"),
        F.sum("tr").cast("bigint").alias("n_train_groups"),
        F.sum("te").cast("bigint").alias("n_test_groups"),
        F.count(F.lit(1)).alias("n_groups"))


def fold_overlap(df: DataFrame, group: str, target: str, col: str = "fold") -> DataFrame:
    """Per fold: rows, positives, groups, and groups shared with the other folds (0 by design)."""
    per_group = df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.min(col).alias("f_min"), F.max(col).alias("f_max"))
    shared = per_group.where(F.col("f_min") != F.col("f_max"))
    rows = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"),
                               F.sum(F.col(target).cast("bigint")).alias("n_pos"),
                               F.countDistinct(group).alias("n_groups"))
    sh = (df.join(shared.select(group), group, "left_semi").groupBy(col)
          .agg(F.countDistinct(group).alias("n_shared")))
    return rows.join(sh, col, "left").select(col, "n", "n_pos", "n_groups",
                                             F.coalesce("n_shared", F.lit(0)).cast("bigint").alias("overlap"))


def compare_splits(df: DataFrame, target: str, key: str, group: str, test_size: float = 0.2, k: int = 5,
                   seed: int = 42) -> DataFrame:
    """the leaky row split and the honest group split side by side.

    One row per scheme: test rows, test share, train/test target rates and the
    number of groups seen on both sides (fold 0 is the held-out part of the group
    split; every fold of it has zero overlap by construction).
    """
    rows = stratified_split(df, target, key, test_size, seed).withColumn("scheme", F.lit("random_stratified"))
    grp = (group_kfold(df, group, k, seed).withColumn("split", F.when(F.col("fold") == 0, "test")
                                                      .otherwise("train"))
           .drop("fold").withColumn("scheme", F.lit("group_kfold")))
    both = rows.select("scheme", group, target, "split").unionByName(grp.select("scheme", group, target, "split"))
    y = F.col(target).cast("double")
    stats = both.groupBy("scheme").agg(
        F.count(F.when(F.col("split") == "test", 1)).alias("n_test"),
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(F.col("split") == "train", y)).alias("train_rate"),
        F.avg(F.when(F.col("split") == "test", y)).alias("test_rate"))
    per_group = both.where(F.col(group).isNotNull()).groupBy("scheme", group).agg(
        F.max((F.col("split") == "train").cast("int")).alias("tr"),
        F.max((F.col("split") == "test").cast("int")).alias("te"))
    ov = per_group.groupBy("scheme").agg(F.sum(F.col("tr") * F.col("te")).cast("bigint").alias("n_both"))
    return stats.join(ov, "scheme").select(
        "scheme", "n_test", (F.col("n_test") / F.col("n")).alias("test_share"), "train_rate", "test_rate", "n_both")
