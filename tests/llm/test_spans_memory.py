"""Repeated windows are joined to passages as they come, in memory that does not grow with their number."""

import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from splitsafe.llm import common, suffix_dedup

SCHEMA = "doc_id long, row long, at int, prev_doc long, prev_row long, prev_at int"


def joined(found):
    out = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def expected(rows, words):
    partners = {}
    for doc, row, at, prev_doc, prev_row, prev_at in rows:
        inside = (prev_doc, prev_row) == (doc, row) and at - prev_at < words
        partners.setdefault((doc, row), {}).setdefault((prev_doc, prev_row, at - prev_at), []).append((prev_at + words if inside else at, at + words))
    out = {}
    for version, some in partners.items():
        own = [(a, b, key[0]) for key, found in some.items() for a, b in joined(found)]
        out[version] = joined((a, b) for a, b, _ in own), sorted(own)
    return out


@pytest.mark.parametrize("in_batch", [1, 3, 10_000])
def test_spans_are_those_of_each_document_by_itself(spark, in_batch):
    rng = random.Random(5)
    rows = []
    for _ in range(120):        # runs of windows, some with gaps, some repeated, some within the document itself
        doc, row, other, at = rng.randint(-2, 9), rng.choice([0, 3]), rng.randint(-2, 9), rng.randint(0, 60)
        prev = (other, rng.choice([0, 3]), rng.randint(0, 90)) if rng.random() < 0.7 else (doc, row, max(0, at - rng.randint(1, 15)))
        rows += [(doc, row, at + i, *prev[:2], prev[2] + i) for i in range(rng.randint(1, 25)) if rng.random() < 0.9 and ((doc, row) != prev[:2] or at > prev[2])]
    rows += rows[:20]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", in_batch)
    try:
        got = suffix_dedup.spans(spark.createDataFrame(rows, SCHEMA), 10).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == len({(r.doc_id, r.row) for r in got})
    assert {(r.doc_id, r.row): ([tuple(c) for c in r.cuts], [tuple(c) for c in r.passages]) for r in got} == expected(rows, 10)
    assert suffix_dedup.spans(spark.createDataFrame([], SCHEMA), 10).count() == 0


def test_spans_of_many_windows_need_little_memory(spark, monkeypatch):
    def watched(task):
        def run(batches):
            tracemalloc.start()
            try:
                yield from task(batches)
                peak = tracemalloc.get_traced_memory()[1]
            finally:
                tracemalloc.stop()
            if peak > 32 << 20:
                raise MemoryError(f"{peak >> 20} MB in a worker")
        return run

    monkeypatch.setattr(common, "lean", watched)
    found = spark.range(400_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(1).cast("long").alias("row"), F.col("id").cast("int").alias("at"),
                                        F.lit(3).cast("long").alias("prev_doc"), F.lit(2).cast("long").alias("prev_row"), (F.col("id") + 5).cast("int").alias("prev_at"))
    got = suffix_dedup.spans(found).collect()
    assert [(r.doc_id, r.row, [tuple(c) for c in r.cuts], [tuple(c) for c in r.passages]) for r in got] == [(7, 1, [(0, 400_049)], [(0, 400_049, 3)])]
