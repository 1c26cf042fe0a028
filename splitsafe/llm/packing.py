"""Cost-balanced packing of documents into sequences of bounded length.

The cost of a sequence is ``linear * tokens + quadratic * sum(piece length ** 2)``, an estimate of dense
layers plus attention inside pieces. Each task packs its own rows in bins of bounded size, so nothing
is shuffled: of a document longer than a sequence, whole sequences are cut first; the rests, in
descending length, go to the lowest-cost sequence with enough capacity left (ties: the earlier one);
a rest that fits nowhere whole is cut over the lowest-cost sequences that have room. The capacities of
a bin add up to its tokens: full sequences, and for the last tokens sequences of powers of two, which
need no padding. So every id lies in exactly one piece and there is no padding at all.

Null text is an empty one (its piece is the end id); a null id is carried as null; repeated rows are
packed each; an empty table gives no rows; extra columns have no effect. ``sequence_id`` is the task's
partition times 2**32 plus a count inside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import common, tokens

BIN_TOKENS = 4_000_000
CHUNK_BYTES = 1 << 20  # of texts encoded at once
OUT_PIECES = 250  # in a batch given out, 2 MB of ids at most
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def capacities(total: int, length: int) -> list[int]:
    """Full sequences, then powers of two for what is left."""
    rest = total % length
    return [length] * (total // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(sizes: np.ndarray, length: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) for every piece."""
    out, seq = [], 0
    for d in np.flatnonzero(sizes >= length):
        for k in range(int(sizes[d]) // length):
            out.append((int(d), k * length, length, seq, 0))
            seq += 1
    rests = sizes % length
    room = np.array(capacities(int(rests.sum()), length), np.int64)
    used = np.zeros(len(room), np.int64)
    cost = np.zeros(len(room))

    def put(d: int, start: int, n: int, s: int) -> None:
        out.append((d, start, n, seq + s, int(used[s])))
        used[s] += n
        room[s] -= n
        cost[s] += linear * n + quadratic * n * n
        if not room[s]:
            cost[s] = np.inf

    left = []
    for d in np.argsort(-rests, kind="stable"):
        n = int(rests[d])
        if not n:
            break
        fits = np.where(room >= n, cost, np.inf)
        s = int(np.argmin(fits))
        if fits[s] == np.inf:
            left.append(int(d))
        else:
            put(int(d), int(sizes[d]) - n, n, s)
    for d in left:
        n = int(rests[d])
        start = int(sizes[d]) - n
        while n:
            s = int(np.argmin(cost))
            take = min(n, int(room[s]))
            put(d, start, take, s)
            start, n = start + take, n - take
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = 2048, linear: float = 1.0,
         quadratic: float = 1 / 2048, id_col: str = "doc_id", text_col: str = "text",
         bin_tokens: int = BIN_TOKENS) -> DataFrame:
    """One row a piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian uint32)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        first = TaskContext.get().partitionId() << 32
        rows: list[tuple[int | None, np.ndarray]] = []
        held = 0

        def flush():
            nonlocal first, rows, held
            sizes = np.array([len(x) for _, x in rows], np.int64)
            pieces = assign(sizes, length, linear, quadratic)
            for at in range(0, len(pieces), OUT_PIECES):
                part = pieces[at:at + OUT_PIECES]
                yield pa.RecordBatch.from_arrays([
                    pa.array([rows[p[0]][0] for p in part], pa.int64()), pa.array([p[1] for p in part], pa.int64()),
                    pa.array([p[2] for p in part], pa.int64()), pa.array([int(sizes[p[0]]) for p in part], pa.int64()),
                    pa.array([first + p[3] for p in part], pa.int64()), pa.array([p[4] for p in part], pa.int64()),
                    pa.array([rows[p[0]][1][p[1]:p[1] + p[2]].astype("<u4").tobytes() for p in part], pa.binary())],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            first += 1 + max((p[3] for p in pieces), default=-1)
            rows, held = [], 0

        for batch in batches:
            at = 0
            for texts in tokens.row_chunks(batch.column("text"), CHUNK_BYTES):
                ids, ends = enc.encode(texts)
                ids = np.insert(ids, ends, end_id)
                ends = ends + np.arange(1, len(ends) + 1)
                rows += zip(batch.column("id")[at:at + len(texts)].to_pylist(), np.split(ids, ends[:-1]))
                at, held = at + len(texts), held + len(ids)
                enc.settle()
                if held >= bin_tokens:
                    yield from flush()
        if rows:
            yield from flush()

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(common.lean(task), SCHEMA))
