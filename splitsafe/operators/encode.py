"""Target encoding (J2 leaky, J3 honest) and memorising scores.

The encoding table is ``groupBy(category).avg(target)`` — one row per category.
It is looked up by :func:`lookup`: rows without a category and rows of the few
heavy ones never move (their entries are broadcast, at most ``HEAVY`` of them);
the others meet a table of any size in an ordinary join.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


HEAVY = 64      # so many categories, those with most rows, are looked up in a broadcast table


def lookup(df: DataFrame, table: DataFrame, keys, null_safe: bool = False) -> DataFrame:
    """``df`` with the columns of ``table`` (one row a key) added, NULL where it has none.

    One aggregate of bounded size (``approx_top_k`` over key hashes) finds the heavy keys. Their rows, and
    rows with a NULL key, which has no entry unless ``null_safe``, go past the shuffle; so one key with any share
    of the rows leaves no large task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    added = [c for c in table.columns if c not in keys]
    whole = F.lit(True) if null_safe else reduce(and_, [F.col(c).isNotNull() for c in keys])
    key_hash = F.xxhash64(*keys)
    found = (df.select(whole.alias("__whole"), key_hash.alias("__h"))
             .agg(F.count(F.lit(1)).alias("n"), F.count_if("__whole").alias("n_whole"),
                  F.expr(f"approx_top_k(__h, {HEAVY}) filter (where __whole)").alias("top"))).first()
    heavy = [r["item"] for r in found["top"] or []]     # whichever the sketch names: the result is the same

    def joined(left, right):
        right = right.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)], *added)
        same = [F.col(c).eqNullSafe(F.col(f"__k{i}")) if null_safe else F.col(c) == F.col(f"__k{i}") for i, c in enumerate(keys)]
        return left.join(right, reduce(and_, same), "left").drop(*[f"__k{i}" for i in range(len(keys))])

    if not heavy and found["n"] == found["n_whole"]:
        return joined(df, table.where(whole))           # no key stands out, or no row is left
    is_heavy = key_hash.isin(heavy) if heavy else F.lit(False)
    stay = joined(df.where(~whole | is_heavy), F.broadcast(table.where(whole & is_heavy)))
    return stay.unionByName(joined(df.where(whole & ~is_heavy), table.where(whole & ~is_heavy)))


def encoding_table(df: DataFrame, cat, target: str, where=None, name: str = "encoded") -> DataFrame:
    cats = [cat] if isinstance(cat, str) else list(cat)
    src = df.where(where) if where is not None else df
    return src.groupBy(*cats).agg(F.avg(F.col(target).cast("double")).alias(name))


def target_encode(df: DataFrame, cat, target: str, where=None, fallback: str | None = "mean",
                  name: str = "encoded", null_safe: bool = False) -> DataFrame:
    """Add the mean target of the row's category, fitted on the rows matching ``where``
    (all rows when None — the leaky arm).  Unseen or NULL categories get the fit
    rows' mean target when ``fallback='mean'`` (the honest arm), else NULL.  ``null_safe=True``
    treats NULL as a category of its own, as row identity does."""
    cats = [cat] if isinstance(cat, str) else list(cat)
    enc = encoding_table(df, cats, target, where, name)
    out = lookup(df, enc, cats, null_safe)     # unless null_safe, NULL keys never match, like a dictionary lookup
    if fallback == "mean":
        src = df.where(where) if where is not None else df
        mean = src.agg(F.avg(F.col(target).cast("double")))          # one value: a scalar subquery
        out = out.withColumn(name, F.coalesce(F.col(name), mean.scalar()))
    return out


def target_encode_oof(df: DataFrame, cat: str, target: str, key: str, split_col: str = "split",
                      k: int = 5, seed: int = 42, name: str = "encoded") -> DataFrame:
    """Out-of-fold target encoding (the option SURVEY Q16 asks for).

    Training rows are dealt into ``k`` folds by ``h(seed:key) mod k``; a training
    row gets the mean target of its category over the *other* training folds, so
    its own label never enters its feature.  Test rows get the mean over all
    training rows of the category.  Unseen categories (or an empty out-of-fold
    set) fall back to the training mean.  One aggregate per (category, fold), summed up per
    category, and one lookup on the category; no row-level loop.
    """
    from ..functions.hashing import hash_int
    is_train = F.col(split_col) == "train"
    y = F.col(target).cast("double")
    folded = df.withColumn("__fold", F.when(is_train, F.pmod(hash_int(seed, key), F.lit(k))))
    train = folded.where(is_train & F.col(cat).isNotNull())
    per_fold = train.groupBy(cat, "__fold").agg(F.sum(y).alias("__sf"), F.count(y).alias("__nf"))
    # one entry a category: its sums, and those of each of the k folds
    table = per_fold.groupBy(cat).agg(
        F.sum("__sf").alias("__s"), F.sum("__nf").alias("__n"),
        F.map_from_entries(F.collect_list(F.struct("__fold", F.struct("__sf", "__nf")))).alias("__folds"))
    mean = folded.where(is_train).agg(F.avg(y)).scalar()
    out = lookup(folded, table, cat)
    own = F.try_element_at("__folds", F.col("__fold"))
    out = out.withColumns({"__sf": own["__sf"], "__nf": own["__nf"]}).drop("__folds")
    oof = F.try_divide(F.col("__s") - F.coalesce(F.col("__sf"), F.lit(0.0)),
                       (F.col("__n") - F.coalesce(F.col("__nf"), F.lit(0))).cast("double"))
    full = F.try_divide(F.col("__s"), F.col("__n").cast("double"))
    enc = F.when(is_train, oof).otherwise(full)
    return (out.withColumn(name, F.coalesce(enc, mean))
            .drop("__fold", "__sf", "__nf", "__s", "__n"))
