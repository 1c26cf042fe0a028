"""Helpers shared by the training-data operators: shared folder, held-out rule, word hashes, components.

A *word* is a maximal run of bytes other than 0x20 and 0x09-0x0D in the UTF-8 text. Word and shingle
hashes are computed with numpy over a whole Arrow batch at a time, in segments of bounded size.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SEGMENT_BYTES = 1 << 20
BATCH_BYTES = 4 << 20  # of an Arrow batch on its way to Python
_M64 = (1 << 64) - 1


# --- tables and the shared folder -----------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where it is unset (tests, a local session) a folder of this machine is chosen; off local
    mode a missing setting is an error, since executors could not see such a folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        known = spark.sparkContext.getCheckpointDir()
        if known:
            d = os.path.dirname(known.rstrip("/"))
        elif spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
            d = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.conf.set("spark.checkpoint.dir", d)
    return d if "://" in d or d.startswith("file:") else "file://" + os.path.abspath(d)


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/llm-{kind}-{uuid.uuid4().hex}"


def local_path(uri: str) -> str | None:
    """The path of a ``file:`` URI, None for another store."""
    if uri.startswith("file://"):
        return "/" + uri[len("file://"):].lstrip("/")
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return None if "://" in uri else uri


@contextmanager
def frugal(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside leave no shuffle files behind and move rows to Python in batches of bounded bytes.

    The session's own settings are put back. A write reads its shuffles only until it ends; another action on the same
    rows plans them anew, so nothing is made twice.
    """
    own = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    before = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, kind)
    with frugal(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Deletes the folders that ``tables``, results of ``written`` or unions of them, read. Nothing may read them later."""
    for t in tables:
        spark = t.sparkSession
        for folder in {unquote(f).rsplit("/", 1)[0] for f in t.inputFiles()}:
            if not folder.rsplit("/", 1)[1].startswith("llm-"):
                raise ValueError(f"{folder} is no folder of written()")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task`` for ``mapInArrow``; its rows go out in batches of bounded bytes, and when it ends, the memory it freed goes back to the system.

    Spark keeps a Python worker for later tasks. What Arrow and the C library hold for reuse in it would count against
    the executor while the later stages run in the JVM, and so would the tables of powers. The JVM reads a batch whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for out in task(batches):
                yield from bounded(out) if isinstance(out, pa.RecordBatch) else [out]
        finally:
            _give_back()

    return run


def bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in slices of ``BATCH_BYTES`` at most (a longer row is a slice of its own)."""
    if batch.num_rows < 2 or batch.nbytes <= BATCH_BYTES:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from bounded(batch.slice(0, half))
        yield from bounded(batch.slice(half))


def _give_back() -> None:
    for powers in (_P_BYTE, *_P_GRAM):
        powers.settle()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library's
    if trim is not None:
        trim(0)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0. A null id counts as held out (never learned from)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- word and shingle hashes ----------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base & _M64))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = _powers(self.base, size), _powers(self.inverse, size)
        return self.up[:n], self.down[:n]

    def settle(self) -> None:
        """At a task's end: drops large tables, which the worker would hold through the later stages."""
        if len(self.up) > 1 << 16:
            self.up = self.down = np.ones(1, np.uint64)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MARKS = _SPACE.copy()
_MARKS[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
_P_BYTE = _Powers(0x9E3779B97F4A7C15)
_P_GRAM = (_Powers(0xD6E8FEB86659FD93), _Powers(0xA0761D6478BD642F))


def _plain(data: np.ndarray) -> np.ndarray:
    """Small letters for A-Z and the Latin-1 capitals (0xC3 0x80-0x9E but the multiplication sign)."""
    out = _LOWER[data]
    second = np.r_[False, data[:-1] == 0xC3] & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    out[second] += 0x20
    return out


def _segment_words(data: np.ndarray, lower: bool, plain: bool = False):
    space = (_MARKS if plain else _SPACE)[data]
    edge = np.diff(space.astype(np.int8), prepend=np.int8(1), append=np.int8(1))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.zeros(0, np.uint64), start, end
    up, down = _P_BYTE.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_plain(data) if plain else _LOWER[data] if lower else data] * up[:-1], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)), start, end


def words_of(data: np.ndarray, lower: bool = True, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every word of a UTF-8 text, in segments cut at white space.

    ``plain``: ASCII punctuation separates words too, and Latin-1 capitals count as small letters.
    """
    if len(data) <= SEGMENT_BYTES:
        return _segment_words(data, lower, plain)
    parts, at = [], 0
    while at < len(data):
        stop = min(len(data), at + SEGMENT_BYTES)
        while stop < len(data):  # move on to white space, so that no word is cut
            gap = np.flatnonzero(_SPACE[data[stop:stop + SEGMENT_BYTES]])
            if len(gap):
                stop += int(gap[0])
                break
            stop = min(len(data), stop + SEGMENT_BYTES)
        h, s, e = _segment_words(data[at:stop], lower, plain)
        parts.append((h, s + at, e + at))
        at = stop
    return tuple(np.concatenate(x) for x in zip(*parts))


def grams(words: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` words (empty if there are fewer). ``which``: one of two functions."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    up, down = _P_GRAM[which].get(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:-1], out=total[1:])
    k = len(words) - n + 1
    return mix((total[n:] - total[:k]) * down[:k])


def shingle_set(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct ``n``-word shingles; a shorter text is one shingle of all its words; no words: empty."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return grams(words, len(words)) + np.uint64(len(words))
    return np.unique(grams(words, n))


def texts_of(column) -> Iterator[np.ndarray | None]:
    """The UTF-8 bytes of each row of an Arrow string column, None for null, without a copy."""
    for c in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        wide = pa.types.is_large_string(c.type) or pa.types.is_large_binary(c.type)
        _, offsets, data = c.buffers()
        at = np.frombuffer(offsets, np.int64 if wide else np.int32)[c.offset:c.offset + len(c) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        valid = c.is_valid().to_numpy(zero_copy_only=False)
        for i in range(len(c)):
            yield raw[at[i]:at[i + 1]] if valid[i] else None


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


# --- connected components -------------------------------------------------------------------------

def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): label is the smallest node reachable over ``edges`` (a, b). Nodes without edges are absent.

    Large-star / small-star rounds; each round's edge list is written to the shared folder. It ends
    when the list is a set of stars; a graph of n nodes needs about log n rounds.
    """
    edges = (edges.select("a", "b").where("a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges = written(edges, "edges")
    for _ in range(max_rounds):
        # large star: every larger neighbour of u points at the least node of u's neighbourhood
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: every smaller neighbour of u, and u, point at the least of them
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low2, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low2.select("a", F.col("m").alias("b"))).distinct())
        new = written(small.where("a <> b"), "edges")
        # stars only, when no node is both a leaf and a centre and every leaf has one centre
        leaves = new.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        open_ = leaves.where("n > 1").select("a").unionAll(
            new.select(F.col("b").alias("a")).distinct().join(leaves.select("a"), "a", "left_semi")).limit(1)
        done = open_.count() == 0
        release(edges)
        edges = new
        if done:
            return (edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
                    .unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()))
    raise RuntimeError("components did not settle")
