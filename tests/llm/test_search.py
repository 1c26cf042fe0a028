"""Ranked search against a score of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from splitsafe.llm import common, search

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERMS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    own = [(i, Counter(terms(t))) for i, t in docs]
    total = sum(sum(c.values()) for _, c in own)
    n_docs = sum(bool(c) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in set(items):
        found = []
        for i, c in own:
            m = 75 + 25 * sum(c.values()) * n_docs // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if s > 0:
                found.append((-s, -math.inf if i is None else i))
        out += [(item, r, None if i == -math.inf else i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("shard", [1, 200, 1 << 19])
def test_ranks_are_those_of_full_scores(spark, seed, shard):
    rng = random.Random(seed)
    words = ["the", "of", "And", "é", "É", "x9", "日本", "a_b", "Z", *[f"w{i}" for i in range(40)]]
    docs = [(i, " ".join(rng.choices(words, [50, 30] + [2] * (len(words) - 2), k=rng.randrange(60)))) for i in range(400)]
    docs += [(500 + i, "the of the same w1, w2") for i in range(150)] + [(7, None), (None, "w1 w3"), (8, ""), (9, " .,"), (7, "w1 w3"), (10, "w5 " * 20000)]
    rng.shuffle(docs)
    items = [(1, "w1 W2 w2 the"), (2, "the"), (3, "nothing here"), (4, None), (5, "..."), (None, "w3"), (1, "w1 W2 w2 the"), (1, "É é"), (6, "same the of w1 w2 w7")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as item_id", "3 as docs").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "5 as doc_id")
    got = search.search(df, bench, 20, slice_items=3 if seed else 100, shard_postings=shard)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, [i for i in items if i[1] is not None], 20)


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.search(docs.where("false"), bench).count() == 0
    assert search.search(docs, bench.where("false")).count() == 0
    assert search.search(docs.selectExpr("doc_id", "cast(null as string) text"), bench).count() == 0
    assert [tuple(r) for r in search.search(docs, bench).collect()] == brute([(1, "a b")], [(1, "a")], 20)


def test_reading_stops_before_the_end():
    """A rare term settles the best documents, so that the long list is not read through."""
    n = 20000
    row = {"docs": np.arange(n).tolist(), "lengths": [10] * n, "terms": [0, 1], "counts": [n, 30],
           "places": np.concatenate([np.arange(n), np.arange(30)]).astype("<u4").tobytes(),
           "tf": np.concatenate([np.arange(n, 0, -1), np.arange(30, 0, -1)]).astype("<u4").tobytes()}
    shard = search.Shard(row, np.array([3, 9000]), n, 10 * n)
    read = []
    real = search.tokens.spread
    search.tokens.spread = lambda a, b: read.append(int(b.sum())) or real(a, b)
    try:
        found = shard.best(np.array([0, 1]), np.array([1, 1]), 20, 0)
    finally:
        search.tokens.spread = real
    assert [d for _, d in found] == list(range(20)) and sum(read) < n // 10


def test_terms():
    texts = ["A_b c9É", "", "x", "ÀB-c"]
    found, n = search.terms_of(pa.array(texts))
    assert [t.decode() for t in found.to_pylist()] == [t for x in texts for t in terms(x)] and n.tolist() == [len(terms(x)) for x in texts]


def test_whole_table_against_duckdb(spark):
    from splitsafe.llm.queries import ORACLES, op12_lexical_search
    from tools.oracle_check import duck
    sf = "/root/testdata/sf0.01"
    got = sorted(map(tuple, op12_lexical_search(spark, sf).collect()))
    assert got == sorted(duck(sf).execute(ORACLES["op12_lexical_search"]).fetchall()) and len(got) > 500
