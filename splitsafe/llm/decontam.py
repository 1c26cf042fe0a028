"""Benchmark decontamination: SimHash windows of each item's size, multi-index Hamming search, exact check.

Words are runs of other bytes than ASCII white space and punctuation, capitals count as small letters. A
document holds an item if some window of the item's number of words (fewer where the document begins or ends
inside it) has a weighted-shingle similarity of at least 0.75 with it: 5-word shingles weighted by how often
they occur, sum of the lesser weights over sum of the greater ones (a shorter item is one shingle of all its words).

*Windows.* A window with m shingles and similarity 0.75 to an item of n shares at least 3(m + n)/7 shingles with
it. So one pass marks the document's shingles that stand in any item, and running sums of the marks give every
position, for every item size, at which a window can hold an item: none that could is left out, at any phase
and under any kind of edit. These windows get SimHash fingerprints (128 bits over the weighted shingles,
from running sums). *Search.* The items' fingerprints of that size are indexed by eight blocks of 16 bits.
Fingerprints within radius 47 agree in at least one block up to 5 bits (eight blocks of 6 would make 48), so
none within the radius is missed. At similarity 0.75 the shingle vectors have a cosine of at least 6/7, which
gives 22 unequal bits of 128 on average, with a deviation of 4.3; the radius lies 5.9 deviations above, that of
unrelated fingerprints is 64. *Check.* The windows found are compared exactly.

The benchmark is the stated query set: its ids and texts go to every task, in slices of ``SLICE`` items, each
a pass over the documents; more items mean more passes, never a larger broadcast. Items without words or
with a null id are left out; null and empty documents hold nothing; repeated rows give a row each; ties
of similarity go to the first window. Long documents are searched in spans of ``CHUNK_WORDS`` window starts.
Empty tables give no rows; extra columns have no effect.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common

SHINGLE, THRESHOLD, RADIUS, BLOCKS = 5, 0.75, 47, 8
NEAR = RADIUS // BLOCKS     # some block of two fingerprints within the radius differs by no more bits
SLICE = 20_000
CHUNK_WORDS = 1 << 15
CELLS = 1 << 20             # windows times items compared at a time


def simhashes(words: np.ndarray, k: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The fingerprint, two 64-bit words, of the k-word shingles of each stretch of ``words``."""
    g = np.stack([common.grams(words, k, which) for which in (0, 1)], axis=1)
    bits = np.unpackbits(g.view(np.uint8).reshape(len(g), 16), axis=1)
    sums = np.zeros((len(g) + 1, 128), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    ones = sums[ends - k + 1] - sums[starts]
    return np.packbits(2 * ones > (ends - starts - k + 1)[:, None], axis=1).view(np.uint64)


def weighted_similarity(a: Counter, b: Counter) -> float:
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


def weights(words: np.ndarray) -> Counter:
    return Counter((common.grams(words, SHINGLE) if len(words) >= SHINGLE else common.grams(words, len(words))).tolist())


class Marks:
    """Membership in a set of shingles, by a table of their low bits and then the sorted set."""

    def __init__(self, shingles: np.ndarray):
        self.sorted = np.unique(shingles)
        self.mask = np.uint64((1 << min(24, max(10, (16 * len(self.sorted)).bit_length()))) - 1)
        self.low = np.zeros(int(self.mask) + 1, bool)
        self.low[self.sorted & self.mask] = True

    def of(self, g: np.ndarray) -> np.ndarray:
        out = self.low[g & self.mask]
        at = np.flatnonzero(out)
        place = np.minimum(np.searchsorted(self.sorted, g[at]), len(self.sorted) - 1)
        out[at] = self.sorted[place] == g[at]
        return out


class Index:
    """The items by number of words: fingerprints, and their values in each 16-bit block; and their shingles."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items: list[tuple[int, int, Counter]] = []
        prints: dict[int, list[np.ndarray]] = {}
        members: dict[int, list[int]] = {}
        shingles: dict[int, list[np.ndarray]] = {}
        for item_id, text in items:
            w = common.words_of(np.frombuffer(text.encode(), np.uint8), plain=True)[0]
            n = len(w)
            if not n:
                continue
            k = min(n, SHINGLE)
            prints.setdefault(n, []).append(simhashes(w, k, np.array([0]), np.array([n]))[0])
            members.setdefault(n, []).append(len(self.items))
            shingles.setdefault(k, []).append(common.grams(w, k))
            self.items.append((item_id, n, weights(w)))
        self.marks = {k: Marks(np.concatenate(g)) for k, g in shingles.items()}
        self.sizes = {}     # shingle size -> item size -> (item numbers, fingerprints, block -> (values, first of each value, order))
        for n in sorted(prints):
            p = np.array(prints[n])
            blocks = []
            for k in range(BLOCKS):
                value, of = np.unique(p.view(np.uint16)[:, k], return_inverse=True)
                order = np.argsort(of, kind="stable")
                blocks.append((value, np.searchsorted(of[order], np.arange(len(value) + 1)), order))
            self.sizes.setdefault(min(n, SHINGLE), {})[n] = (np.array(members[n]), p, blocks)

    @staticmethod
    def near(known: np.ndarray, blocks: list, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, place among the items) of every pair of fingerprints within the radius."""
        step = max(1, CELLS // len(known))
        for at in range(0, len(prints), step):
            part = prints[at:at + step]
            seen = np.zeros((len(part), len(known)), bool)
            for k, (value, first, order) in enumerate(blocks):
                win, v = np.nonzero(np.bitwise_count(part.view(np.uint16)[:, k][:, None] ^ value) <= NEAR)
                n = first[v + 1] - first[v]
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                seen[np.repeat(win, n), order[np.repeat(first[v], n) + inner]] = True
            win, item = np.nonzero(seen)
            close = np.bitwise_count(part[win] ^ known[item]).sum(axis=1) <= RADIUS
            yield at + win[close], item[close]

    def search(self, docs: list[np.ndarray]) -> Iterator[tuple[int, int, int, float]]:
        """(document, item, first word, similarity): each item found in each document, at its best window."""
        lengths = np.array([len(d) for d in docs], np.int64)
        words = np.concatenate(docs) if docs else np.zeros(0, np.uint64)
        begin = np.cumsum(lengths) - lengths
        for k, sizes in self.sizes.items():
            total = np.zeros(max(1, len(words) - k + 2), np.int64)
            np.cumsum(self.marks[k].of(common.grams(words, k)), out=total[1:])
            last = np.maximum(begin, begin + lengths - k + 1)
            least = min(sizes) - k + 1
            held = total[np.minimum(last, len(total) - 1)] - total[np.minimum(begin, len(total) - 1)]
            for d in np.flatnonzero((lengths >= k) & (4 * held >= 3 * least)).tolist():
                yield from self._search_one(d, docs[d], k, sizes, total[begin[d]:last[d] + 1] - total[begin[d]])

    def _search_one(self, d: int, doc: np.ndarray, k: int, sizes: dict, total: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """``total``: running sums of the marked shingles of ``doc``."""
        best: dict[int, tuple[float, int]] = {}
        longest = max(sizes)
        for low in range(-longest, len(doc), CHUNK_WORDS):
            high = min(len(doc), low + CHUNK_WORDS)
            left, right = max(0, low), min(len(doc), high + longest)
            marked = total[max(0, right - k + 1)] - total[left] if right - left >= k else 0
            found = []      # (item size, starts)
            for size in sizes:
                n = size - k + 1
                if 4 * marked < 3 * n:
                    continue
                s = np.arange(max(low, -(n // 4)), min(high, len(doc) - size + n // 4 + 1))
                a, b = np.maximum(s, 0), np.minimum(s + size, len(doc))
                s = s[b - a >= k]
                a, b = np.maximum(s, 0), np.minimum(s + size, len(doc))
                s = s[7 * (total[b - k + 1] - total[a]) >= 3 * (b - a - k + 1 + n)]
                if len(s):
                    found.append((size, s))
            if not found:
                continue
            left = max(0, min(int(s[0]) for _, s in found))
            right = min(len(doc), max(int(s[-1]) + size for size, s in found))
            a = np.concatenate([np.maximum(s, 0) for _, s in found]) - left
            b = np.concatenate([np.minimum(s + size, len(doc)) for size, s in found]) - left
            prints, at = simhashes(doc[left:right], k, a, b), 0
            for size, s in found:
                members, known, blocks = sizes[size]
                for win, hit in self.near(known, blocks, prints[at:at + len(s)]):
                    for start, item in zip(s[win].tolist(), members[hit].tolist()):
                        x = weighted_similarity(self.items[item][2], weights(doc[max(0, start):start + size]))
                        if x >= THRESHOLD and (-x, start) < best.get(item, (0.0, 0)):
                            best[item] = (-x, start)
                at += len(s)
        for item, (x, start) in sorted(best.items()):
            yield d, item, max(0, start), -x


def _slices(benchmark: DataFrame, id_col: str, text_col: str, size: int = SLICE) -> Iterator[list[tuple[int, str]]]:
    """The items in slices of bounded size, in id order; each slice alone is on the driver."""
    rows = (benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
            .where("item_id is not null and text is not null").distinct())
    last: tuple | None = None
    while True:
        more = rows if last is None else rows.where(F.struct("item_id", "text") > F.struct(F.lit(last[0]).alias("item_id"), F.lit(last[1]).alias("text")))
        got = [(r["item_id"], r["text"]) for r in more.orderBy("item_id", "text").limit(size).collect()]
        if not got:
            return
        yield got
        if len(got) < size:
            return
        last = got[-1]


def _runs(column, chunk: int = CHUNK_WORDS) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, word hashes of each text) in runs of bounded size."""
    at, held, docs = 0, 0, []
    for i, raw in enumerate(common.texts_of(column)):
        docs.append(common.words_of(raw, plain=True)[0] if raw is not None else np.zeros(0, np.uint64))
        held += len(docs[-1])
        if held >= chunk:
            yield at, docs
            at, held, docs = i + 1, 0, []
    if docs:
        yield at, docs


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
         item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, first_word, similarity: one row for each item that a document holds."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, first_word long, similarity double"

    def one(items: list[tuple[int, str]]) -> DataFrame:
        index = docs.sparkSession.sparkContext.broadcast(Index(items))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ix = index.value
            for batch in batches:
                ids = batch.column("doc_id")
                for at, words in _runs(batch.column("text")):
                    got = list(ix.search(words))
                    if got:
                        yield pa.RecordBatch.from_arrays([
                            pa.array([ids[at + d].as_py() for d, *_ in got], pa.int64()), pa.array([ix.items[i][0] for _, i, *_ in got], pa.int64()),
                            pa.array([s for _, _, s, _ in got], pa.int64()), pa.array([x for *_, x in got], pa.float64())],
                            ["doc_id", "item_id", "first_word", "similarity"])

        return own.mapInArrow(common.lean(task), schema)

    found = [one(items) for items in _slices(benchmark, item_id_col, item_text_col)]
    return reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are. No shuffle."""
    at = docs.columns.index(text_col)

    def without(rows: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
        index = docs.sparkSession.sparkContext.broadcast(Index(items))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ix = index.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for first, words in _runs(batch.column(at)):
                    for d, *_ in ix.search(words):
                        keep[first + d] = False
                yield batch.filter(pa.array(keep))

        return rows.mapInArrow(common.lean(task), docs.schema)

    return reduce(without, _slices(benchmark, item_id_col, item_text_col), docs)
