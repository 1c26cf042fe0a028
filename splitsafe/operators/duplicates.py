"""Exact duplicate rows (H1), keep-first de-duplication (H2) and bag union (H3).

Duplicate semantics follow pandas ``duplicated``: rows equal on every compared
column, NULL equal to NULL, NaN equal to NaN and -0.0 equal to 0.0 (Spark's
grouping normalises floating keys the same way).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

WIDE_COLUMNS = 12
FILTER_BITS_PER_KEY = 16        # two bits set a key: about 1.4 % of other rows pass
MAX_FILTER_BITS = 1 << 29       # 64 MB; with more keys more rows pass, the result is the same
_SEGMENT = 32_768               # bits of one bitmap of Spark's bitmap functions


def _row_key(df: DataFrame, cols) -> list[F.Column]:
    """Two 64-bit hashes of a row that also encode *where* the NULLs are.

    ``xxhash64`` skips NULL inputs, so (NULL, 1) and (1, NULL) would collide;
    prefixing each value with its null flag makes positions count.  Float zeros
    are normalised so -0.0 and 0.0 hash alike.
    """
    parts = []
    for c in cols:
        x = F.col(c)
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            x = F.when(x == 0, F.lit(0.0).cast(df.schema[c].dataType)).otherwise(x)
        parts += [F.col(c).isNull(), x]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def _repeated_keys(df: DataFrame, cols) -> tuple[DataFrame, int]:
    """The row keys that occur more than once, written, and how many. The exchange carries 16 bytes a row."""
    h1, h2 = _row_key(df, cols)
    keys = cut_lineage(df.select(h1.alias("__h1"), h2.alias("__h2")).groupBy("__h1", "__h2").count()
                       .where("count > 1").select("__h1", "__h2"))
    return keys, keys.count()


def _maybe_repeated(df: DataFrame, cols, keys: DataFrame, n: int, name: str = "__maybe") -> DataFrame:
    """``df`` with its row key and a flag: False only where the row is certainly the only one of its kind.

    The flag is a Bloom filter of the repeated keys, made of bitmaps of 4 KB, ``FILTER_BITS_PER_KEY / 8`` bytes a
    key and at most ``MAX_FILTER_BITS / 8`` in all: that bounds the broadcast, and no row is exchanged for it.
    """
    bits = min(max(n * FILTER_BITS_PER_KEY, _SEGMENT), MAX_FILTER_BITS)
    maps = (keys.select(F.expr(f"explode(array(pmod(__h1, {bits}), pmod(__h2, {bits})))").alias("__p"))
            .groupBy(F.expr(f"__p div {_SEGMENT}").alias("__s"))
            .agg(F.expr(f"bitmap_construct_agg(__p % {_SEGMENT})").alias("__b")))
    h1, h2 = _row_key(df, cols)
    out, flags = df.select("*", h1.alias("__h1"), h2.alias("__h2")), []
    for i, h in enumerate(("__h1", "__h2")):
        m = maps.select(F.col("__s").alias(f"__s{i}"), F.col("__b").alias(f"__b{i}"))
        out = out.join(F.broadcast(m), F.expr(f"pmod({h}, {bits}) div {_SEGMENT}") == F.col(f"__s{i}"), "left")
        spot = f"pmod({h}, {bits}) % {_SEGMENT}"
        byte = f"cast(conv(hex(substring(__b{i}, cast({spot} div 8 as int) + 1, 1)), 16, 10) as int)"
        flags.append(F.expr(f"coalesce(shiftright({byte}, cast({spot} % 8 as int)) & 1 = 1, false)"))
    return out.withColumn(name, flags[0] & flags[1]).drop("__s0", "__b0", "__s1", "__b1")


def duplicate_count(df: DataFrame, cols=None, wide_columns: int = WIDE_COLUMNS) -> DataFrame:
    """One row: ``n_rows, exact_dupes`` where exact_dupes = rows equal to an earlier row.

    Narrow tables: ``groupBy(all columns).count()`` with map-side partial
    aggregation.  Wide tables: a first pass exchanges only a 128-bit row key; a Bloom
    filter of the keys that repeat then picks, before any exchange, the rows that are
    grouped on their full content, which verifies every candidate exactly (neither
    equal keys nor the filter's false positives can change the count).
    """
    cols = list(cols) if cols is not None else list(df.columns)
    if len(cols) <= wide_columns:
        g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
        return g.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("n_rows"),
                     F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("exact_dupes"))
    keys, n = _repeated_keys(df, cols)
    n_rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
    if not n:
        return n_rows.select("n_rows", F.lit(0).cast("bigint").alias("exact_dupes"))
    cand = _maybe_repeated(df.select(*cols), cols, keys, n).where("__maybe")
    dup = (cand.groupBy("__h1", "__h2", *cols).agg(F.count(F.lit(1)).alias("__n"))
           .agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("exact_dupes")))
    return _one_row_zip(n_rows, dup)


def _one_row_zip(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side-by-side of two single-row aggregates: ``b``'s columns as scalar subqueries."""
    return a.select("*", *[b.select(c).scalar().alias(c) for c in b.columns])


def drop_duplicates(df: DataFrame, cols=None, row_key: str | None = None, wide_columns: int = WIDE_COLUMNS) -> DataFrame:
    """H2 keep-first: one row per distinct ``cols``; with ``row_key`` the kept row is the
    one with the smallest key (pandas' "first" made explicit), else plain distinct.

    Of a wide table only rows whose key repeats (see :func:`duplicate_count`) are exchanged; the others
    stay where they are.
    """
    cols = list(cols) if cols is not None else [c for c in df.columns if c != row_key]
    out = [*cols] if row_key is None else [*cols, row_key]

    def dedup(rows):
        return rows.select(*cols).distinct() if row_key is None else rows.groupBy(*cols).agg(F.min(row_key).alias(row_key))

    if len(cols) <= wide_columns:
        return dedup(df.select(*out))
    keys, n = _repeated_keys(df, cols)
    if not n:
        return df.select(*out)
    flagged = _maybe_repeated(df.select(*out), cols, keys, n)
    return flagged.where("not __maybe").select(*out).unionByName(dedup(flagged.where("__maybe").select(*out)))


def append(base: DataFrame, extra: DataFrame, copy_col: str = "copy_no") -> DataFrame:
    """H3: bag union by name; ``copy_no`` tells originals (0) from appended rows (1)."""
    b = base if copy_col in base.columns else base.withColumn(copy_col, F.lit(0))
    e = extra.withColumn(copy_col, F.lit(1))
    return b.unionByName(e)
