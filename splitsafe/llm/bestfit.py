"""Best-fit decreasing packing of all documents into as few sequences of bounded length as it finds.

1. Every text is encoded once (end id behind it), cut into pieces only where it is longer than a sequence, and
   written with a number ``k``: how many pieces of the same length stand before it in its partition.
2. Spark counts the pieces of every (partition, length); prefix sums over partitions turn ``k`` into the piece's
   rank among all pieces of its length. The counts by length, at most one row a length, go to the driver.
3. Best-fit decreasing runs over these counts: lengths in descending order, each piece into the open sequence with
   the least room that holds it, found in a segment tree over the room left (logarithmic in the sequence length).
   Sequences of equal room are interchangeable, so a run of them takes a run of equal pieces in one step, with
   exactly the sequences that a piece-by-piece loop over the whole corpus makes. A step makes at most two runs of
   sequences more, and a run is met at most once a length, by at most 63 different lengths (1 + ... + 64 > 2048),
   so the plan is bounded by the sequence length whatever the corpus.
4. Each piece finds its sequence and place by a binary search of (length, rank) in the plan.

Null text is an empty one (its piece is the end id); a null id is carried as null; repeated rows are packed each;
an empty table gives no rows; extra columns have no effect; a very long text is encoded alone, in memory of a small
multiple of its size, and its pieces are rows of their own. Which of several equal pieces stands in which of several
equal sequences follows the partitions of the input; the number of sequences and their lengths don't depend on them.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import common, tokens

RANK_BITS = 40
ENCODED = "doc_id long, piece int, start long, length int, ids binary, part int, k long"
PACKED = "doc_id long, piece int, start long, length long, sequence_id long, offset long, ids binary"


class RoomTree:
    """Which amounts of room some open sequence has, with the least amount of at least ``n`` in logarithmic time."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.any = [False] * (2 * self.size)

    def set(self, room: int, there: bool) -> None:
        i = room + self.size
        self.any[i] = there
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def least(self, n: int) -> int | None:
        i = n + self.size
        while not self.any[i]:
            while i & 1:            # a right child: go up until a subtree lies to the right
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.size


def plan(counts: dict[int, int], length: int) -> tuple[np.ndarray, int]:
    """(rows, number of sequences) of best-fit decreasing over ``counts`` pieces of each length.

    A row (size, rank, sequence, per sequence, offset): from this rank on, pieces of this size go, ``per sequence``
    together, into consecutive sequences from ``sequence`` on, the first of each at ``offset``.
    """
    tree, open_ = RoomTree(length), {}
    rows, used = [], 0

    def keep(room: int, first: int, n: int) -> None:
        if room:
            if room not in open_:
                open_[room] = deque()
                tree.set(room, True)
            open_[room].append((first, n))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            room = tree.least(size)
            if room is None:
                room = length
                first, n = used, -(-left // (length // size))
                used += n
            else:
                first, n = open_[room].popleft()
                if not open_[room]:
                    del open_[room]
                    tree.set(room, False)
            per = room // size
            full = min(n, left // per)
            rows.append((size, rank, first, per, length - room))
            rank, left = rank + full * per, left - full * per
            if full:
                keep(room - per * size, first, full)
            if full < n and left:                                  # the last pieces, fewer than a sequence takes
                keep(room - left * size, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            if full < n:
                keep(room, first + full, n - full)
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5), used


def encode(docs: DataFrame, tokenizer: str, end_id: int, length: int, id_col: str, text_col: str) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = tokens.encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(length + 1, np.int64)
        for batch in batches:
            at = 0
            for texts in tokens.row_chunks(batch.column("text")):
                ids, ends = enc.encode(texts)
                ids = np.insert(ids, ends, end_id)
                sizes = np.diff(ends + np.arange(1, len(ends) + 1), prepend=0)
                n = -(-sizes // length)
                row = np.repeat(np.arange(len(sizes)), n)
                piece = tokens.spread(np.zeros(len(n), np.int64), n)
                lengths = np.minimum(sizes[row] - piece * length, length)
                # how often each length came before: in this partition, then in this chunk
                order = np.argsort(lengths, kind="stable")
                new = np.flatnonzero(np.diff(lengths[order], prepend=0))
                k = np.empty(len(row), np.int64)
                k[order] = np.arange(len(row)) - np.repeat(new, np.diff(np.append(new, len(row))))
                k += seen[lengths]
                seen += np.bincount(lengths, minlength=length + 1)
                cut = np.append(0, np.cumsum(lengths)) * enc.dtype.itemsize
                for i in range(0, len(row), 4000):
                    j = min(i + 4000, len(row))
                    own = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [
                        None, pa.py_buffer(np.ascontiguousarray(cut[i:j + 1])), pa.py_buffer(ids)])
                    yield pa.RecordBatch.from_arrays([
                        batch.column("id").take(pa.array(at + row[i:j])), pa.array(piece[i:j], pa.int32()),
                        pa.array(piece[i:j] * length), pa.array(lengths[i:j], pa.int32()), own.cast(pa.binary()),
                        pa.array(np.full(j - i, part, np.int32)), pa.array(k[i:j])],
                        ["doc_id", "piece", "start", "length", "ids", "part", "k"])
                at += len(texts)

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(task, ENCODED))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, length: int = 2048, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, piece, start, length, sequence_id, offset, ids (little-endian uint32)."""
    pieces = common.written(encode(docs, tokenizer, end_id, length, id_col, text_col), "pieces")
    counts = common.written(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    rows, _ = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, length)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    wide = np.dtype("<u2") if tokens.encoder(tokenizer).dtype.itemsize == 2 else np.dtype("<u4")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (rows[:, 0] << RANK_BITS) | rows[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column("length").to_numpy().astype(np.int64)
            rank = batch.column("rank").to_numpy()
            step = rows[np.searchsorted(keys, (size << RANK_BITS) | rank, "right") - 1]
            nth = rank - step[:, 1]
            ids = batch.column("ids")
            flat = np.frombuffer(b"".join(ids.to_pylist()), wide).astype("<u4")
            cut = np.append(0, np.cumsum(size)) * 4
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("piece"), batch.column("start"), pa.array(size),
                pa.array(step[:, 2] + nth // step[:, 3]), pa.array(step[:, 4] + nth % step[:, 3] * size),
                pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(cut), pa.py_buffer(flat)])
                .cast(pa.binary())],
                ["doc_id", "piece", "start", "length", "sequence_id", "offset", "ids"])

    return (pieces.join(base, ["part", "length"])
            .select("doc_id", "piece", "start", "length", (F.col("base") + F.col("k")).alias("rank"), "ids")
            .mapInArrow(place, PACKED))
