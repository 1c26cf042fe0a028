"""What a Python task holds at most, and what it leaves in its worker."""

import pickle
import re
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from splitsafe.llm import common, jaccard_join, quality, tokens

_KEPT = []


def resident_mb():
    return int(re.search(r"Rss:\s+(\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024


def test_freed_memory_goes_back_when_a_task_ends():
    def task(batches):
        held = [np.ones(12_000) for _ in range(1500)]       # about 96 KB each, 144 MB
        _KEPT.append(np.ones(12_000))                       # something behind them that stays
        yield from batches
        held.clear()

    before = resident_mb()
    assert list(common.lean(task)(iter([1, 2]))) == [1, 2]
    assert resident_mb() - before < 60
    assert list(pickle.loads(cloudpickle.dumps(common.lean(jaccard_join._verify)))(iter([]))) == []   # as Spark sends it


def test_accepted_gives_out_a_large_batch_in_runs():
    class Docs:
        columns, schema = ["doc_id", "text"], None
        sparkSession = property(lambda self: self)
        sparkContext = property(lambda self: self)

        def broadcast(self, value):
            return type("B", (), {"value": value})

        def mapInArrow(self, task, schema):
            return task

    class Model:
        vectors = quality.index_vectors()

        def score(self, x):
            return np.where(x[:, quality.DIM:].any(1), 0.9, 0.1)

    texts = ["a word " * 20_000 if i % 3 else "" for i in range(120)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(120)), pa.array(texts)], ["doc_id", "text"])
    out = list(quality.accepted(Docs(), Model())(iter([batch, batch.slice(0, 0)])))
    assert [i for b in out for i in b.column("doc_id").to_pylist()] == [i for i in range(120) if i % 3]
    assert max(b.get_total_buffer_size() for b in out) < batch.nbytes / 2


def test_survey_counts_repeats_without_copies_of_the_chunk():
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 1 << 40, 1000))) for _ in range(450)]
    texts += [t[:3000] + " more" for t in texts[:5]] * 2 + [texts[0][:2000], texts[7]]
    column = pa.array(texts)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, min(i + 20, len(texts)))), column.slice(i, 20)], ["doc_id", "text"])
               for i in range(0, len(texts), 20)]
    sets = {tuple(s.tolist()) for _, s in jaccard_join._sets(pa.RecordBatch.from_arrays([column], ["text"]), "text")}
    flat = np.concatenate([np.array(s, np.uint64) for s in sets])
    list(jaccard_join._survey(iter(batches[:1])))           # tables that grow on first use
    tracemalloc.start()
    out = pa.Table.from_batches(list(jaccard_join._survey(iter(batches))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    rows = out.to_pylist()
    token, n = np.unique(flat, return_counts=True)
    assert {r["token"]: r["count"] for r in rows if r["token"] is not None} == dict(zip(common.signed(token[n >= 2]).tolist(), n[n >= 2].tolist()))
    assert n.max() == 3 and [r["doc_id"] for r in rows if r["token"] is None] == list(range(len(texts)))
    assert peak < 3 * flat.nbytes, peak / flat.nbytes


def test_settle_drops_a_large_cache_only(monkeypatch):
    enc = tokens.Encoder(tokens.default_tokenizer())
    column = pa.array([" ".join(f"w{i}" for i in range(500))])
    want = enc.encode(column)[0].tolist()
    enc.settle()
    assert enc.known
    monkeypatch.setattr(tokens, "KEPT_PIECES", 100)
    enc.settle()
    assert not enc.known and enc.encode(column)[0].tolist() == want
