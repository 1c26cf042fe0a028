"""Ranked lexical search: no random access (NRA) over impact-sorted posting lists, by shards of documents.

Terms are maximal runs of ASCII letters and digits and of characters from U+0080 on, A-Z lower-cased.

1. ``index``: one pass over the documents makes shards of bounded size, a row each: for every term of the items the
   documents that hold it and how often, and the number and the length of all documents.
2. Spark adds up the shards' counts: documents by term (df), N and L. A posting's impact, ``weight(df) *
   saturation(tf, length)``, is all it adds to a score.
3. In each shard lists are sorted by impact. For an item, its lists are read in step, from the greatest impact down
   and without access by document. A document's score lies between the sum of the impacts read so far (lower) and
   that sum plus the last impact read of each list where it has not been met (upper). Reading goes on until no
   document whose upper end reaches the k-th lower end has an open interval: members, ties and final scores are
   then settled. Shards of one task pass the k-th score on.
4. Each task gives its best k an item; Spark ranks them.

A document without text has no terms. Rows with one doc_id are documents of their own; a null id is carried as null
and stands before others of equal score. Every distinct (item_id, text) is an item of its own, also with a null id;
an item without terms, or an empty table, gives no rows. Extra columns have no effect. A very long text is counted
alone, in memory of a small multiple of its size. Items are taken in slices of about ``SLICE`` (one pass over the
documents each), so the terms and weights that tasks hold are bounded by a slice, whatever the documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import common, tokens

SLICE = 10_000
SHARD_POSTINGS = 1 << 19
FIRST_BLOCK = 64
NULL_ID = -(1 << 63)
INDEX = ("shard long, docs array<long>, lengths array<long>, terms array<int>, counts array<int>, "
         "places binary, tf binary, n_docs long, n_terms long")
FOUND = "item int, item_id long, doc_id long, score long"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of a string column without nulls, and how many each row has."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if at[-1] == at[0]:
        return pa.array([], pa.large_binary()), np.zeros(len(column), np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True                                           # a term ends with its text
    first = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
    last = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False)))
    ends = np.append(0, np.cumsum(last + 1 - first))
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [
        None, pa.py_buffer(ends), pa.py_buffer(_LOWER[data[inside]])])
    return found, np.diff(np.searchsorted(first, at))


def index(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text",
          shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """Shards of posting lists of the vocabulary's terms: ``places`` (uint32 position in ``docs``) and ``tf`` (uint32)
    of all lists joined, ``counts`` of them for each of ``terms``; ``docs`` are those with a term of the vocabulary."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(held.value, pa.large_binary())
        size, shard = len(words), TaskContext.get().partitionId() << 32
        ids, lengths, keys, tfs, n_docs, n_terms, kept, docs_ = [], [], [], [], 0, 0, 0, 0

        def flush() -> pa.RecordBatch:
            key = np.concatenate([*keys, np.zeros(0, np.int64)])
            place, term = key // max(size, 1), key % max(size, 1)
            order = np.argsort(term, kind="stable")
            distinct, counts = np.unique(term, return_counts=True)

            def row(x, kind):
                x = pa.array(x, kind)
                return pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)

            own = np.concatenate([*ids, np.zeros(0, np.int64)])
            return pa.RecordBatch.from_arrays([
                pa.array([shard]), row(own, pa.int64()), row(np.concatenate([*lengths, np.zeros(0, np.int64)]), pa.int64()),
                row(distinct.astype(np.int32), pa.int32()), row(counts.astype(np.int32), pa.int32()),
                pa.array([place[order].astype("<u4").tobytes()], pa.binary()),
                pa.array([np.concatenate([*tfs, np.zeros(0, np.int64)])[order].astype("<u4").tobytes()], pa.binary()),
                pa.array([n_docs]), pa.array([n_terms])],
                ["shard", "docs", "lengths", "terms", "counts", "places", "tf", "n_docs", "n_terms"])

        for batch in batches:
            names = batch.column("id").fill_null(NULL_ID).to_numpy()
            at = 0
            for texts in tokens.row_chunks(batch.column("text")):
                found, n = terms_of(texts)
                hit = pc.index_in(found, value_set=words)
                known = hit.is_valid().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(n)), n)[known]
                key, tf = np.unique(row * size + hit.drop_null().to_numpy(), return_counts=True)
                mine, local = np.unique(key // max(size, 1), return_inverse=True)
                keys.append((docs_ + local) * size + key % max(size, 1))
                tfs.append(tf)
                ids.append(names[at + mine])
                lengths.append(n[mine])
                n_docs, n_terms, kept, docs_ = n_docs + int((n > 0).sum()), n_terms + int(n.sum()), kept + len(key), docs_ + len(mine)
                at += len(texts)
                if kept >= shard_postings:
                    yield flush()
                    shard += 1
                    ids, lengths, keys, tfs, n_docs, n_terms, kept, docs_ = [], [], [], [], 0, 0, 0, 0
        if n_docs:
            yield flush()

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .mapInArrow(task, INDEX))


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """The posting lists of a shard's row, each sorted by impact, greatest first."""

    def __init__(self, row: dict, weights: np.ndarray, n_docs: int, n_terms: int):
        self.docs = np.array(row["docs"], np.int64)
        m = 75 + 25 * np.array(row["lengths"], np.int64) * n_docs // max(n_terms, 1)
        place, tf = np.frombuffer(row["places"], "<u4").astype(np.int64), np.frombuffer(row["tf"], "<u4").astype(np.int64)
        counts = np.array(row["counts"], np.int64)
        terms = np.array(row["terms"], np.int64)
        own = np.repeat(np.arange(len(terms)), counts)
        impact = weights[terms][own] * (1_000_000_000 * tf // (1000 * tf + 12 * m[place]))
        order = np.lexsort((-impact, own))
        self.place, self.impact = place[order], impact[order]
        self.first = np.zeros(len(weights), np.int64)
        self.size = np.zeros(len(weights), np.int64)
        self.first[terms], self.size[terms] = np.cumsum(counts) - counts, counts

    def best(self, terms: np.ndarray, repeats: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """(score, doc) of every document that may be among the best ``k`` and scores at least ``floor``; scores are final."""
        there = self.size[terms] > 0
        terms, repeats = terms[there], repeats[there]
        if not len(terms):
            return []
        first, size = self.first[terms], self.size[terms]
        lower = np.zeros(len(self.docs), np.int64)
        met = np.zeros((len(terms), len(self.docs)))
        read, block = np.zeros(len(terms), np.int64), FIRST_BLOCK
        while True:
            n = np.minimum(block, size - read)
            at = tokens.spread(first + read, n)
            which = np.repeat(np.arange(len(terms)), n)
            np.add.at(lower, self.place[at], self.impact[at] * repeats[which])
            met[which, self.place[at]] = 1
            read, block = read + n, 2 * block
            # what a list may still add to a document not met in it: its last impact read, nothing after its end
            open_ = np.where(read < size, self.impact[first + read - 1] * repeats, 0)
            upper = lower + (open_.sum() - (open_.astype(float) @ met).astype(np.int64))
            bar = max(floor, int(np.partition(lower, -k)[-k]) if len(lower) >= k else 0, 1)
            alive = np.flatnonzero(upper >= bar)
            if (upper[alive] == lower[alive]).all():
                order = np.lexsort((self.docs[alive], -lower[alive]))[:k]
                return [(int(lower[i]), int(self.docs[i])) for i in alive[order]]


def items_of(benchmark: DataFrame, id_col: str, text_col: str, size: int = SLICE) -> Iterator[list[tuple[int | None, str]]]:
    """The distinct (id, text) items in slices of about ``size``, dealt by hash; each slice alone is on the driver."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("t is not null").distinct()
    slices = -(-rows.count() // size)
    for s in range(slices):
        yield [(r["i"], r["t"]) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(slices)) == s).collect()]


def search(docs: DataFrame, benchmark: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", slice_items: int = SLICE,
           shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the best ``k`` documents of every item; equal scores by ascending doc_id."""
    spark = docs.sparkSession
    parts = []
    for number, items in enumerate(items_of(benchmark, item_id_col, item_text_col, slice_items)):
        asked = [Counter(terms_of(pa.array([t]))[0].to_pylist()) for _, t in items]
        vocabulary = sorted(set().union(*asked))
        if not vocabulary:
            continue
        shards = common.written(index(docs, vocabulary, id_col, text_col, shard_postings), "search")
        total = shards.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).collect()[0]
        if not total["n"]:
            continue
        df = (shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms")
              .agg(F.sum("x.counts").alias("df")).collect())          # at most one row a term of the slice
        weights = np.zeros(len(vocabulary), np.int64)
        for r in df:
            weights[r["terms"]] = weight(r["df"], total["n"])
        place = {t: i for i, t in enumerate(vocabulary)}
        queries = [(np.array([place[t] for t in a], np.int64), np.array(list(a.values()), np.int64)) for a in asked]
        held = spark.sparkContext.broadcast((weights, queries, [i for i, _ in items], total["n"], total["l"]))

        def task(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            weights, queries, names, n_docs, n_terms = held.value
            top: list[list[tuple[int, int]]] = [[] for _ in queries]
            for batch in batches:
                for i in range(batch.num_rows):
                    shard = Shard(batch.slice(i, 1).to_pylist()[0], weights, n_docs, n_terms)
                    for q, (terms, repeats) in enumerate(queries):
                        floor = top[q][-1][0] if len(top[q]) == k else 0
                        more = shard.best(terms, repeats, k, floor)
                        if more:
                            top[q] = sorted(top[q] + more, key=lambda x: (-x[0], x[1]))[:k]
            rows = [(q, names[q], d, s) for q, found in enumerate(top) for s, d in found]
            if rows:
                item, name, doc, score = zip(*rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(item, pa.int32()), pa.array(name, pa.int64()),
                    pa.array([None if d == NULL_ID else d for d in doc], pa.int64()), pa.array(score, pa.int64())],
                    ["item", "item_id", "doc_id", "score"])

        columns = ["docs", "lengths", "terms", "counts", "places", "tf"]
        parts.append(shards.select(*columns).mapInArrow(task, FOUND).withColumn("slice", F.lit(number)))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("slice", "item").orderBy(F.desc("score"), F.asc("doc_id"))
    return (reduce(DataFrame.unionAll, parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
