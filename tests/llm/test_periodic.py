"""Runs by recompression against a brute-force search, and the query's digests."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from splitsafe.llm import common, periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, shortest=6):
    n, best = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 4 * q):
                best.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted((s, n_, q) for (s, n_), q in best.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sample(rng):
    words = ["a", "b", "c", "dé", "日"][:rng.choice([1, 2, 3, 5])]
    out = []
    while len(out) < rng.randrange(1, 120):
        unit = rng.choices(words, k=rng.randrange(1, 12))
        out += (unit * rng.randrange(1, 9))[:rng.randrange(1, 60)]
    return out


@pytest.mark.parametrize("seed", range(12))
def test_runs_and_collapsed_texts(seed):
    rng = random.Random(seed)
    docs = [sample(rng) for _ in range(150)] + [["x"] * 5, ["x"] * 6, ["x", "y"] * 4, ["x", "y"] * 3]
    rng.shuffle(docs)
    texts = [rng.choice(["", " ", "\n\t"]) + rng.choice([" ", "\t ", "\r\n"]).join(d) + rng.choice(["", " "]) for d in docs]
    texts += ["", "  ", "\n"]
    docs += [[], [], []]
    n, runs, out = periodic.collapse(pa.array(["skipped", *texts]).slice(1))
    at = 0
    for d, k, t in zip(docs, n, out.to_pylist()):
        own = [tuple(r) for r in runs[at:at + k].tolist()]
        at += k
        assert own == brute(d) and t == collapsed(d, own)
    assert at == len(runs)


@pytest.mark.parametrize("seed", range(8))
def test_agreement_of_all_pairs_of_places(seed):
    rng = np.random.default_rng(seed)
    body = np.concatenate([np.tile(rng.integers(0, 3, rng.integers(1, 9)), rng.integers(1, 6)) for _ in range(12)])
    text = np.concatenate([[90], body, [91]])
    g = periodic.Grammar(text)
    i, j = np.triu_indices(len(text), 1)
    fwd = [next(k for k in range(len(text)) if text[a + k] != text[b + k]) for a, b in zip(i, j)]
    back = [next(k for k in range(len(text)) if text[a - k] != text[b - k]) for a, b in zip(i, j)]
    assert g.agree(i, j, True).tolist() == fwd and g.agree(i, j, False).tolist() == back


def test_long_runs():
    for unit, n in (("a", 200_000), ("a b c", 50_000), (" ".join(f"w{i}" for i in range(1000)), 37)):
        w = (unit.split() * n)[:-1]
        count, runs, out = periodic.collapse(pa.array(["z " + " ".join(w) + " end"]))
        p = len(unit.split())
        assert runs.tolist() == [[1, len(w), p]] and out.to_pylist() == [f"z {unit} end"]


def planted(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def row(doc_id, text):
    w = planted(doc_id, text)
    runs = brute(w)
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, runs).encode()).hexdigest())


def test_query_on_a_whole_table_and_odd_rows(spark):
    from splitsafe.llm.queries import periodic_digest
    docs = common.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    odd = [(1, None), (2, ""), (3, " \t\n"), (None, "a b " * 9), (None, None), (4, "x " * 40), (4, "x " * 40), (-7, "q w e " * 5)]
    odd += [(i, "one two three\n four  five six " * (i % 7)) for i in range(100, 160)]
    clash = spark.createDataFrame(odd, "doc_id long, text string").selectExpr("*", "1 as runs", "2 as collapsed", "3 as ws", "4 as id")
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    for df in (docs, clash):
        got = [tuple(r[c] for c in names) for r in periodic_digest(df).collect()]
        assert sorted(got, key=repr) == sorted((row(r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    assert periodic_digest(docs.where("false")).count() == 0
