"""Edited copies of benchmark items against an exact search over every window."""

import numpy as np
import pytest

from splitsafe.llm import decontam


def exact(doc, item):
    """The best similarity over every window of the item's size, clipped at the document's ends."""
    want, size = decontam.weights(item), len(item)
    return max((decontam.weighted_similarity(want, decontam.weights(doc[max(0, s):s + size])) for s in range(-size // 4 - 1, len(doc))
                if len(doc[max(0, s):s + size])), default=0.0)


def edited(rng, kind, item):
    n = len(item)
    at = int(rng.integers(0, n))
    new = rng.integers(1 << 40, 1 << 41, 5).astype(np.uint64)
    if kind == "insert":
        return np.insert(item, at, new[:1 + at % 3])
    if kind == "delete":
        return np.delete(item, slice(at, at + 1 + at % 3))
    if kind == "replace":
        out = item.copy()
        out[at:at + 1 + at % 5] = new[:len(out[at:at + 1 + at % 5])]
        return out
    if kind == "move":
        return np.roll(item, n // 2)
    if kind == "clip":
        return item[n // 5:] if at % 2 else item[:n - n // 5]
    return item


@pytest.fixture(scope="module")
def bench():
    rng = np.random.default_rng(5)
    texts = [(i, " ".join(f"w{x}" for x in rng.integers(0, 3000, int(n)))) for i, n in enumerate([1, 2, 4, 5, 6, *range(8, 75), 100, 200])]
    return texts, decontam.Index(texts)


@pytest.mark.parametrize("kind", ["same", "insert", "delete", "replace", "move", "clip"])
def test_every_window_counts(bench, kind):
    texts, index = bench
    rng = np.random.default_rng(len(kind))
    words = lambda t: decontam.common.words_of(np.frombuffer(t.encode(), np.uint8), plain=True)[0]
    held = 0
    for i, text in texts:
        item = words(text)
        for phase in range(8):
            copy = edited(rng, kind, item)
            before, after = (rng.integers(1 << 41, 1 << 42, k).astype(np.uint64) for k in (phase if kind != "clip" else 0, 30 if kind != "clip" else 0))
            doc = np.concatenate([before, copy, after])
            best = exact(doc, item)
            got = {index.items[k][0]: x for _, k, _, x in index.search([np.zeros(0, np.uint64), doc, before])}
            assert (i in got) == (best >= 0.75), (kind, i, len(item), phase, best)
            if i in got:
                held += 1
                assert got[i] == best
    assert held >= (100 if kind != "clip" else 50)


def test_long_document_in_spans(bench, monkeypatch):
    texts, index = bench
    words = lambda t: decontam.common.words_of(np.frombuffer(t.encode(), np.uint8), plain=True)[0]
    rng = np.random.default_rng(1)
    parts = [x for _, t in texts[5:] for x in (rng.integers(1 << 41, 1 << 42, 17).astype(np.uint64), words(t))]
    whole = list(index.search([np.concatenate(parts)]))
    monkeypatch.setattr(decontam, "CHUNK_WORDS", 13)
    monkeypatch.setattr(decontam, "CELLS", 7)
    assert list(index.search([np.concatenate(parts)])) == whole and {i for _, i, _, _ in whole} >= set(range(5, len(texts)))


def test_spark_rows_of_edits(spark, bench):
    texts, _ = bench
    long = [(i, t.split()) for i, t in texts if len(t.split()) >= 40]
    rows = [(i, " ".join(w[len(w) // 2:] + w[:len(w) // 2])) for i, w in long] + [(1000 + i, "a b " + " ".join([*w[:9], "new", *w[9:]])) for i, w in long]
    got = decontam.find(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(texts, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, i) for i, _ in long} | {(1000 + i, i) for i, _ in long}
