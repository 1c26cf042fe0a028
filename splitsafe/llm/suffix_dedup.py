"""Removal of repeated passages with a sparse suffix array.

A passage is a run of at least ``min_words`` (50) words that occurs twice or more, in other documents or in
the same one. Its first occurrence (smallest document id, then position) stays, the others are cut out.

1. *Sampling.* Of the ``min_words - ANCHOR + 1`` word positions that begin any window of that many words the
   one with the least hash of its ``GRAM`` words is retained (a minimiser), so two equal passages retain the
   same positions. The suffix at a retained position is known by the hash of its first ``ANCHOR`` words.
2. *Sorting.* The suffixes are range-partitioned and sorted by (hash, document, position), and each is
   compared with its neighbour; suffixes equal to none fall away. A common passage is many rows, which the
   range partitioning spreads over tasks; rows at the edges of tasks are compared in a second small step.
3. *Extending.* Around each suffix left, the match is extended left and right to ``min_words``: every window
   of that length whose minimiser it is, is hashed to 128 bits, and sorted and compared in the same way.
   A window equal to an earlier one is a repeat; adjacent windows join to passages of any length, each
   reported with the document of the nearest earlier occurrence, those of different partners apart.

A window that repeats one which it overlaps (a periodic text) is cut only where it goes beyond it, so that
one full window stays. Words are runs of bytes other than ASCII white space, compared exactly. Texts with
fewer than ``min_words`` words, empty and null ones are left as they are. Rows with a null id are left as
they are and compared with nothing; rows that share an id are compared as one document's versions (``row``
tells them apart). Empty tables give no rows; extra columns have no effect on what is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common

MIN_WORDS, GRAM = 50, 6
RANGES = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
PASSAGES = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("other", pa.int64())]))


def anchor_words(min_words: int) -> int:
    return min_words // 2 + 1


def minimisers(words: np.ndarray, window: int, gram: int) -> np.ndarray:
    """For each start of ``window`` positions, the position with the least gram hash (the last such one)."""
    h = common.grams(words, gram)
    if len(h) < window:
        return np.zeros(0, np.int64)
    # running minimum over blocks of `window`: suffix minima of one block against prefix minima of the next
    n = len(h)
    size = -(-n // window) * window
    key = np.full(size, np.iinfo(np.uint64).max)
    key[:n] = h
    at = np.arange(size)
    rows, pos = key.reshape(-1, window), at.reshape(-1, window)
    low = np.minimum.accumulate(rows, 1)
    left = np.maximum.accumulate(np.where(rows == low, pos, -1), 1).ravel()          # last least so far
    back = np.minimum.accumulate(rows[:, ::-1], 1)
    new = np.c_[np.ones((len(rows), 1), bool), back[:, 1:] < back[:, :-1]]
    right = np.maximum.accumulate(np.where(new, np.arange(window), 0), 1)
    right = np.take_along_axis(pos[:, ::-1], right, 1)[:, ::-1].ravel()              # last least from here on
    a, b = right[:n - window + 1], left[window - 1:n]
    return np.where(key[b] <= key[a], b, a)


def _words(raw) -> np.ndarray:
    return common.words_of(raw, lower=False)[0] if raw is not None else np.zeros(0, np.uint64)


def _with_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _text_key(raw) -> int:
    """Tells the rows of a repeated id apart: equal rows are one version."""
    import zlib
    return zlib.crc32(raw) if raw is not None else 0


def _suffixes(min_words: int, gram: int):
    anchor = anchor_words(min_words)
    window = min_words - anchor + 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out, held = batch.column("doc_id").to_pylist(), [], 0
            for i, raw in enumerate(common.texts_of(batch.column("text"))):
                w = _words(raw)
                if len(w) >= min_words and ids[i] is not None:
                    at = minimisers(w[:len(w) - anchor + gram], window, gram)
                    at = at[np.r_[True, at[1:] != at[:-1]]]
                    out.append((common.signed(common.grams(w, anchor)[at]), np.full(len(at), ids[i]), np.full(len(at), _text_key(raw)), at.astype(np.int32)))
                    held += len(at)
                if out and (held > 200_000 or i + 1 == batch.num_rows):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[j] for x in out])) for j in range(4)], ["h", "doc_id", "row", "at"])
                    out, held = [], 0

    return task


def _neighbours(keys: int, flags: str):
    """Over rows sorted by ``keys`` hash columns and the place: is the row before, or after, of the same key?

    Adds prev_doc, prev_row, prev_at (of an equal row just before, else null), twin (an equal neighbour on either
    side) and edge (first or last row of the task, whose other neighbour is not seen here). The hashes are given for
    edge rows only, which are compared once more.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        first = True

        def rows(cols, keep, same_prev, same_next, edge):
            prev = [np.r_[c[:1], c[:-1]] for c in cols[keys:keys + 3]]
            out = [pa.array(c[keep], mask=~edge[keep]) for c in cols[:keys]] + [pa.array(c[keep]) for c in cols[keys:]]
            out += [pa.array(p[keep], mask=~same_prev[keep]) for p in prev]
            out += [pa.array((same_prev | same_next)[keep]), pa.array(edge[keep])]
            return pa.RecordBatch.from_arrays(out, names + ["prev_doc", "prev_row", "prev_at", "twin", "edge"])

        names: list[str] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            # `last` holds the two rows before: one given out already, one that waits for its next
            head = 0 if last is None else len(last[0])
            if last is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(last, cols)]
            n = len(cols[0])
            equal = np.logical_and.reduce([c[1:] == c[:-1] for c in cols[:keys]])
            same_prev, same_next = np.r_[False, equal], np.r_[equal, False]
            give = np.ones(n, bool)
            give[-1] = False                  # waits
            give[:max(0, head - 1)] = False   # given out before
            edge = np.zeros(n, bool)
            edge[0] = first
            yield from _chosen(rows, cols, give, same_prev, same_next, edge, flags)
            first = first and n < 2
            last = [c[-2:] for c in cols]
        if last is not None:
            n = len(last[0])
            equal = np.logical_and.reduce([c[1:] == c[:-1] for c in last[:keys]]) if n > 1 else np.zeros(0, bool)
            give, edge = np.zeros(n, bool), np.zeros(n, bool)
            give[-1] = edge[-1] = True
            yield from _chosen(rows, last, give, np.r_[False, equal], np.r_[equal, False], edge, flags)

    return task


def _chosen(rows, cols, give, same_prev, same_next, edge, flags):
    want = (same_prev | same_next) if flags == "twin" else same_prev
    keep = give & (want | edge)
    if keep.any():
        yield rows(cols, keep, same_prev, same_next, edge)


def _sorted(rows: DataFrame, keys: list[str]) -> DataFrame:
    place = [*keys, "doc_id", "row", "at"]
    return rows.select(*place).repartitionByRange(common.partitions_for(rows.sparkSession), *place).sortWithinPartitions(*place)


NEXT = "prev_doc long, prev_row long, prev_at int, twin boolean, edge boolean"


def _twins(suffixes: DataFrame) -> DataFrame:
    """(doc_id, row, at) of the suffixes that equal another."""
    got = common.written(_sorted(suffixes, ["h"]).mapInArrow(
        common.lean(_neighbours(1, "twin")), "h long, doc_id long, row long, at int, " + NEXT), "suffixes")
    edges = got.where("edge")
    several = edges.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    lone = edges.where("not twin").join(several, "h", "left_semi")
    return got.where("twin").select("doc_id", "row", "at").unionByName(lone.select("doc_id", "row", "at"))


def _extend(min_words: int, gram: int):
    """Every window of ``min_words`` words whose minimiser is a suffix that has a twin."""
    anchor = anchor_words(min_words)
    window = min_words - anchor + 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, row, anchors = (batch.column(k).to_pylist() for k in ("doc_id", "row", "anchors"))
            out, held = [], 0
            for i, raw in enumerate(common.texts_of(batch.column("text"))):
                if _text_key(raw) == row[i]:
                    w = _words(raw)
                    at = minimisers(w[:len(w) - anchor + gram], window, gram)
                    start = np.flatnonzero(np.isin(at, np.array(anchors[i], np.int64)))
                    a, b = (common.signed(common.grams(w, min_words, k)[start]) for k in (0, 1))
                    out.append((a, b, np.full(len(start), ids[i]), np.full(len(start), row[i]), start.astype(np.int32)))
                    held += len(start)
                if out and (held > 200_000 or i + 1 == batch.num_rows):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[j] for x in out])) for j in range(5)],
                                                     ["g", "h", "doc_id", "row", "at"])
                    out, held = [], 0

    return task


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, gram: int = GRAM) -> DataFrame:
    """(doc_id, row, at, prev_doc, prev_row, prev_at): windows that repeat an earlier one, and where the one before stands."""
    own = _with_rows(docs, id_col, text_col)
    suffixes = common.written(own.mapInArrow(common.lean(_suffixes(min_words, gram)), "h long, doc_id long, row long, at int"), "anchors")
    same = _twins(suffixes)
    twins = common.written(same.groupBy("doc_id", "row").agg(F.collect_list("at").alias("anchors")), "twins")
    common.release(suffixes, same)
    windows = common.written(
        own.join(twins, "doc_id").select("doc_id", "row", "anchors", "text")
        .mapInArrow(common.lean(_extend(min_words, gram)), "g long, h long, doc_id long, row long, at int"), "windows")
    common.release(twins)
    got = common.written(_sorted(windows, ["g", "h"]).mapInArrow(
        common.lean(_neighbours(2, "prev")), "g long, h long, doc_id long, row long, at int, " + NEXT), "repeats")
    common.release(windows)
    place = ["doc_id", "row", "at"]
    # a task's first row may repeat rows of tasks before it: the least edge row of its key is earlier
    edges = got.where("edge")
    least = edges.groupBy("g", "h").agg(F.min(F.struct(*place)).alias("z"))
    late = (edges.where("prev_doc is null").join(least, ["g", "h"]).where(F.struct(*place) > F.col("z"))
            .select(*place, F.col("z.doc_id").alias("prev_doc"), F.col("z.row").alias("prev_row"), F.col("z.at").alias("prev_at")))
    same = F.expr("prev_doc = doc_id and prev_row = row and prev_at = at")  # a repeated row is no earlier occurrence of itself
    return (got.where("prev_doc is not null").select(*place, "prev_doc", "prev_row", "prev_at").unionByName(late)
            .where(~same))


def _runs(rows: list[np.ndarray], keys: int) -> list[np.ndarray]:
    """Ranges in order of ``keys`` columns, from and to (the last two), those of a key that overlap or touch joined."""
    *key, start, end = rows
    new = np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in key[:keys]])]
    part = np.cumsum(new)
    last = np.maximum.accumulate((part << 32) + end)  # the furthest end so far: a later key's are beyond those before
    first = np.flatnonzero(new | np.r_[False, (part[1:] << 32) + start[1:] > last[:-1]])
    return [*(c[first] for c in key), start[first], (last[np.r_[first[1:] - 1, len(new) - 1]] & 0xFFFFFFFF).astype(np.int32)]


def _documents(runs: list[np.ndarray]) -> pa.RecordBatch:
    """The rows of ``spans`` of all runs of some document versions, in their order."""
    doc, row, other, _, _, start, end = runs
    new = np.r_[True, (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])]
    which = np.cumsum(new) - 1
    order = np.lexsort((other, end, start, which))
    which, start, end, other = which[order], start[order], end[order], other[order]
    cut, cut_start, cut_end = _runs([which, start, end], 1)

    def lists(which, kind, *fields):
        at = np.searchsorted(which, np.arange(new.sum() + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([pa.array(x) for x in fields], fields=list(kind.value_type)))

    return pa.RecordBatch.from_arrays([pa.array(doc[new]), pa.array(row[new]), lists(cut, RANGES, cut_start, cut_end),
                                       lists(which, PASSAGES, start, end, other)], ["doc_id", "row", "cuts", "passages"])


def _merge(min_words: int):
    """Rows of ``spans`` from windows sorted by document version, partner, shift and place.

    Windows are joined as they come; of a document that is not over yet, only the runs are held.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # runs of the document that is not over
        last = None                        # and its latest, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, row, other, other_row, shift, at = (c.to_numpy() for c in batch.columns)
            inside = (other == doc) & (other_row == row) & (shift < min_words)
            rows = [doc, row, other, other_row, shift, np.where(inside, at - shift + min_words, at).astype(np.int32), (at + min_words).astype(np.int32)]
            if last is not None:
                rows = [np.concatenate(x) for x in zip(last, rows)]
            runs = _runs(rows, 5)
            last, over = [c[-1:] for c in runs], [c[:-1] for c in runs]
            n = len(over[0]) - int(((over[0] == last[0]) & (over[1] == last[1])).sum())
            if n:
                yield _documents([np.concatenate(x) for x in zip(*held, [c[:n] for c in over])])
                held = []
            held.append([c[n:] for c in over])
        if last is not None:
            yield _documents([np.concatenate(x) for x in zip(*held, last)])

    return task


def spans(found: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row a document version: doc_id, row, cuts (from, to): the words to cut, and passages (from, to, other).

    A passage's words stand, as one run, in ``other`` too: windows join only where they repeat the same version
    at the same distance. Passages of several partners may overlap; cuts do not. Spark sorts the windows, so that
    no list of a document's windows is built.
    """
    place = ["doc_id", "row", "other", "other_row", "shift", "at"]
    kind = ("doc_id long, row long, cuts array<struct<`from`: int, `to`: int>>, "
            "passages array<struct<`from`: int, `to`: int, other: long>>")
    return (found.select("doc_id", "row", F.col("prev_doc").alias("other"), F.col("prev_row").alias("other_row"), (F.col("at") - F.col("prev_at")).alias("shift"), "at")
            .repartition("doc_id", "row").sortWithinPartitions(*place).mapInArrow(common.lean(_merge(min_words)), kind))


def cut_text(raw: bytes, cuts: list[dict]) -> str:
    """The text without the cut words: from the first byte of a cut's first word to the next word kept."""
    _, start, end = common.words_of(np.frombuffer(raw, np.uint8), lower=False)
    out, at = [], 0
    for c in cuts:
        out.append(raw[at:start[c["from"]]])
        at = int(start[c["to"]]) if c["to"] < len(start) else len(raw)
    out.append(raw[at:])
    return b"".join(out).decode()


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
          drop_emptied: bool = True) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text_col``; a row that loses all its words goes."""
    found = repeats(docs, id_col, text_col, min_words)
    cuts = common.written(spans(found, min_words).drop("passages"), "cuts")
    common.release(found)
    names = docs.columns
    flat = cuts.select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), F.col("cuts").alias("__cuts"))
    key = F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0))
    with_cuts = docs.join(flat, (docs[id_col].cast("long") == flat["__id"]) & (key == flat["__row"]), "left")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, col = batch.column("__cuts"), batch.column(names.index(text_col))
            texts = [cut_text(col[i].as_py().encode(), c[i].as_py()) if c[i].is_valid else col[i].as_py() for i in range(batch.num_rows)]
            keep = pa.array([not (drop_emptied and c[i].is_valid and not t.strip(" \t\n\r\x0b\x0c")) for i, t in enumerate(texts)], pa.bool_())
            cols = [pa.array(texts, pa.string()) if k == names.index(text_col) else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, names).filter(keep)

    return with_cuts.select(*[docs[n] for n in names], "__cuts").mapInArrow(common.lean(task), docs.schema)
