"""What a packing task holds and sends at once, and what any task leaves in its worker."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from splitsafe.llm import common, packing, tokens
from tests.conftest import SF001


def _task(monkeypatch):
    """The function that ``pack`` hands to ``mapInArrow``."""
    class Docs:
        def select(self, *cols):
            return self

        def mapInArrow(self, task, schema):
            return task

    column = type("C", (), {"cast": lambda self, kind: self, "alias": lambda self, name: self})()
    monkeypatch.setattr(packing.F, "col", lambda name: column)
    context = type("T", (), {"partitionId": lambda self: 0})()
    monkeypatch.setattr(packing.TaskContext, "get", staticmethod(lambda: context))
    return packing.pack(Docs(), tokens.default_tokenizer())


def test_rows_go_out_in_batches_of_bounded_bytes():
    texts = ["x" * 3000] * 5000 + ["y" * (common.BATCH_BYTES + 1), None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    out = list(common.lean(lambda batches: batches)(iter([batch, batch.slice(0, 0)])))
    assert pa.Table.from_batches(out).equals(pa.Table.from_batches([batch]))
    assert all(b.nbytes <= common.BATCH_BYTES or b.num_rows == 1 for b in out)


def test_a_task_leaves_no_large_tables_of_powers():
    words = np.arange(200_000, dtype=np.uint64)

    def task(batches):
        for b in batches:
            task.found = common.grams(words, 5)
            common.words_of(np.full(300_000, 97, np.uint8))
            yield b

    assert list(common.lean(task)(iter([1]))) == [1]
    assert max(len(p.up) for p in (common._P_BYTE, *common._P_GRAM)) <= 1 << 16
    assert np.array_equal(common.grams(words, 5), task.found)


def test_packing_holds_and_sends_bounded_bytes(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"{x:x}" for x in rng.integers(0, 1 << 40, 4000)) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts)], ["id", "text"])
    monkeypatch.setattr(tokens, "KEPT_PIECES", 50_000)
    known, own = [], tokens.Encoder.encode

    def encode(self, column):
        known.append((len(self.known), column.nbytes))
        return own(self, column)

    monkeypatch.setattr(tokens.Encoder, "encode", encode)
    out = list(_task(monkeypatch)(iter([batch])))
    assert max(n for n, _ in known) <= 50_000                    # 240,000 distinct pieces in all
    assert max(size for _, size in known) < 1.5 * (1 << 20)
    assert max(b.num_rows for b in out) <= packing.OUT_PIECES
    ids = {}
    for r in pa.Table.from_batches(out).to_pylist():
        ids.setdefault(r["doc_id"], {})[r["start"]] = r["ids"]
    whole, ends = own(tokens.Encoder(tokens.default_tokenizer()), batch.column("text"))
    for i, part in enumerate(np.split(whole, ends[:-1])):
        assert b"".join(ids[i][s] for s in sorted(ids[i])) == np.append(part, 1).astype("<u4").tobytes()


def test_pipeline_packs_in_small_batches(spark):
    """The texts of the last stage go to Python under ``common.frugal``, whoever writes the result."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = corpus_pipeline.packed(spark, docs, SF001)
    assert got.inputFiles() and all("/llm-pieces-" in f for f in got.inputFiles())
    want = corpus_pipeline.pieces_digest(packing.pack(docs, tokens.default_tokenizer()))
    assert got.columns == want.columns and got.select(F.sum("length")).first() == want.select(F.sum("length")).first()
