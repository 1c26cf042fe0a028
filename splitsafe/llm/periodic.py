"""Periodic runs of words by recompression.

A *run* is a stretch of words with smallest period q, of at least ``max(shortest, 4 * q)`` words, that no neighbouring
word extends keeping period q. Words are maximal runs of bytes other than 0x20 and 0x09-0x0D; equal words are equal bytes.

The words of a batch of documents, with a word of its own between documents, are compressed in turns until one symbol
is left: runs of one symbol become a symbol (block compression), then each pair of a symbol of one half of the alphabet
and a following one of the other half becomes a symbol (pair compression; the better of a few random halves). Equal
stretches are cut alike except at their ends, so the run-length grammar answers how far two places agree, forwards or
backwards, by walking up its levels while they agree and down again after a difference (``Grammar.agree``): a number of
steps logarithmic in the answer, for many pairs of places at once.

A run of period q meets at least three multiples of q in a row, beginning with some i whose words i, i + q, i + 2 q and
i + 3 q are equal, whatever i is counted from. So for every q the multiples of q (a harmonic grid of n / 1 + n / 2 + ...
places) that pass this test are the candidates; the agreement of i and i + q in both directions is the exact stretch
of period q around i. A stretch found with several periods has the smallest of them.

Null or blank texts have no runs and an empty collapsed text; a null id is carried as null; repeated rows give a row
each; an empty table gives none; only the id and text columns are read. A document is the unit of work: a very long
text takes about 150 bytes of a worker's memory a word (besides its bytes), and its candidates are tested in chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common, tokens

BATCH_BYTES = 4 << 20
CANDIDATES = 1 << 20
HALVES = 4
SHORTEST = 6
SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class Grammar:
    """Levels of symbols; symbol p of the next level stands for symbols ``first[p]`` to ``first[p + 1]`` of this one."""

    def __init__(self, word: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
        s = np.unique(word, return_inverse=True)[1].astype(np.int32)
        while len(s) > 1:
            s = self._add(s, self._blocks(s), len(s))
            if len(s) > 1:
                s = self._add(s, self._pairs(s, rng), 1)

    @staticmethod
    def _blocks(s: np.ndarray) -> np.ndarray:
        return np.append(0, np.flatnonzero(s[1:] != s[:-1]) + 1)

    @staticmethod
    def _pairs(s: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        best = None
        while best is None or not best.any():
            for _ in range(HALVES):
                left = rng.integers(0, 2, int(s.max()) + 1, dtype=np.int8).astype(bool)[s]
                for pair in (left[:-1] & ~left[1:], ~left[:-1] & left[1:]):
                    if best is None or pair.sum() > best.sum():
                        best = pair
        return np.flatnonzero(np.append(True, ~best))          # the second symbol of a pair begins none

    def _add(self, s: np.ndarray, first: np.ndarray, shared: int) -> np.ndarray:
        """Keeps a level and returns the next: a symbol alone keeps its name, equal groups get equal new names.
        ``shared``: how many symbols two different groups of equal first (or last) symbols may have in common."""
        size = np.diff(np.append(first, len(s)))
        if len(first) == len(s):
            return s                                            # nothing to compress: no level
        parent = np.repeat(np.arange(len(first), dtype=np.int32), size)
        up = s[first].astype(np.int64)
        more = np.flatnonzero(size > 1)
        second = s[first[more] + 1].astype(np.int64)
        # a block has one symbol and a size of its own, a pair two different symbols and size 2
        names = int(s.max()) + 1
        key = np.where(second == up[more], size[more], 0)
        pair = up[more] * names + second
        order = np.lexsort((key, pair))
        new = np.append(True, (np.diff(pair[order]) != 0) | (np.diff(key[order]) != 0)) if len(order) else np.zeros(0, bool)
        up[more[order]] = names + np.cumsum(new) - 1
        self.levels.append((s, parent, np.append(first, len(s)).astype(np.int32), shared))
        return np.unique(up, return_inverse=True)[1].astype(np.int32)

    def agree(self, i: np.ndarray, j: np.ndarray, forwards: bool) -> np.ndarray:
        """How many symbols of level 0 agree from different places i and j on (``forwards``) or back from them (else).

        Some symbol that is alone in the text must lie between the two places' agreement and the text's end."""
        a, b = i.astype(np.int64), j.astype(np.int64)
        step = 1 if forwards else -1
        stop = np.zeros(len(a), np.int32)                       # the level on which the pair was found to differ
        going = np.arange(len(a))
        for h, (s, parent, first, _) in enumerate(self.levels):
            x, y = a[going], b[going]
            differ = s[x] != s[y]
            stop[going[differ]] = h
            going, x, y = going[~differ], x[~differ], y[~differ]
            if not len(going):
                break
            p, q = parent[x], parent[y]
            if forwards:                                        # symbols left of the group that x and y stand in
                rx, ry, at_edge = first[p + 1] - x, first[q + 1] - y, (first[p] == x) & (first[q] == y)
            else:
                rx, ry, at_edge = x - first[p] + 1, y - first[q] + 1, (first[p + 1] == x + 1) & (first[q + 1] == y + 1)
            # inside a group: its rest is passed; where the rests differ, the symbols behind the shorter one do too
            n = np.where(at_edge, 0, np.minimum(rx, ry))
            x, y = x + step * n, y + step * n
            apart = ~at_edge & (rx != ry)
            a[going[apart]], b[going[apart]], stop[going[apart]] = x[apart], y[apart], h
            up = ~apart
            going = going[up]
            a[going], b[going] = parent[x[up]], parent[y[up]]
        for h in range(len(self.levels) - 2, -1, -1):           # down: the first groups that differ share a beginning
            down = np.flatnonzero(stop > h)
            if not len(down):
                continue
            s, _, first, shared = self.levels[h]
            p, q = a[down], b[down]
            x, y = (first[p], first[q]) if forwards else (first[p + 1] - 1, first[q + 1] - 1)
            n = np.minimum(np.minimum(first[p + 1] - first[p], first[q + 1] - first[q]), shared)
            n[s[x] != s[y]] = 0
            a[down], b[down] = x + step * n, y + step * n
        return step * (a - i)


def candidates(word: np.ndarray, ends: np.ndarray, shortest: int = SHORTEST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) on the harmonic grids, in chunks, by ascending period. ``ends`` of documents, longest first."""
    sizes = np.diff(np.append(0, ends))
    places, periods, held = [], [], 0
    for q in range(1, int(sizes.max(initial=0)) // 4 + 1):
        upto = ends[np.searchsorted(-sizes, -4 * q, "right") - 1]      # documents of at least 4 q words
        grid = word[:upto:q]
        same = grid[1:] == grid[:-1]
        i = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * q
        if len(i):
            places.append(i)
            periods.append(np.full(len(i), q))
            held += len(i)
            if held >= CANDIDATES:
                yield np.concatenate(places), np.concatenate(periods)
                places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def runs_of(word: np.ndarray, ends: np.ndarray, shortest: int = SHORTEST) -> np.ndarray:
    """(start, length, period) of all runs, by start, then period. ``word``: numbers of the words of documents that end
    before ``ends``, longest document first, each document's last symbol a number of its own."""
    found = np.zeros((0, 3), np.int64)
    grammar = None
    for place, period in candidates(word, ends):
        if grammar is None:
            # the text's two ends get symbols of their own as well; places move by one
            grammar = Grammar(np.concatenate([[word.max() + 1], word, [word.max() + 2]]))
        after = grammar.agree(place + 1, place + period + 1, True)
        before = grammar.agree(place, place + period, False)
        length = before + period + after
        keep = length >= np.maximum(shortest, 4 * period)
        found = np.concatenate([found, np.stack([place - before, length, period], 1)[keep]])
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        # the smallest period of each stretch
        found = found[np.append(True, (np.diff(found[:, 0]) != 0) | (np.diff(found[:, 1]) != 0))[:len(found)]]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, first byte and size of every word, words of each row) of a string column without nulls."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if at[-1] == at[0]:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), none, none, np.zeros(len(column), np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    inside = ~common._SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    first = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
    last = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False)))
    return data, first, last + 1 - first, np.diff(np.searchsorted(first, at))


def collapse(column: pa.Array, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(number of runs of each row, their (start, length, period), texts without the repeats) of a string column."""
    data, first, size, n = words_of(column)
    total, rows = len(first), len(n)
    cut = np.append(0, np.cumsum(size))
    packed = data[tokens.spread(first, size)] if total else data
    number = pa.LargeBinaryArray.from_buffers(pa.large_binary(), total, [None, pa.py_buffer(cut), pa.py_buffer(packed)])
    number = number.dictionary_encode().indices.to_numpy().astype(np.int64) if total else np.zeros(0, np.int64)
    # documents in descending length, a symbol of its own behind each
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    begin = np.cumsum(n) - n
    ends = np.cumsum(n[order] + 1)
    text = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    marks = ends - 1
    text[marks] = total + np.arange(len(marks))
    inside = np.ones(len(text), bool)
    inside[marks] = False
    text[inside] = number[tokens.spread(begin[order], n[order])]
    runs = runs_of(text, ends, shortest)
    which = np.searchsorted(ends, runs[:, 0], "right")
    runs[:, 0] -= (ends - n[order] - 1)[which]
    doc = order[which]
    by_doc = np.argsort(doc, kind="stable")
    runs, doc = runs[by_doc], doc[by_doc]
    # words of a run after its first period are dropped
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, begin[doc] + runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, begin[doc] + runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(change)[:total] == 0
    kept = np.bincount(np.repeat(np.arange(rows), n)[keep], minlength=rows)
    wide = size[keep] + 1                                        # a space behind each word but a row's last
    ends_ = np.cumsum(kept)
    wide[ends_[kept > 0] - 1] -= 1
    out = np.full(int(wide.sum()), 0x20, np.uint8)
    out[tokens.spread(np.cumsum(wide) - wide, size[keep])] = data[tokens.spread(first[keep], size[keep])]
    at = np.append(0, np.append(0, np.cumsum(wide))[ends_])
    texts = pa.LargeStringArray.from_buffers(rows, pa.py_buffer(at), pa.py_buffer(out))
    return np.bincount(doc, minlength=rows), runs, texts


def find(docs: DataFrame, shortest: int = SHORTEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, its runs (start, length, period; by start, then period), and ``collapsed``: its
    words, joined by single spaces, without those that some run contains after that run's first period."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in tokens.row_chunks(batch.column("text"), BATCH_BYTES):
                n, runs, collapsed = collapse(texts, shortest)
                runs = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in range(3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(at, len(texts)),
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), runs),
                    collapsed.cast(pa.string())], ["doc_id", "runs", "collapsed"])
                at += len(texts)

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .mapInArrow(task, SCHEMA))
