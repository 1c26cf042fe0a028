"""The rows of the corpus pipeline against its stages worked out one document at a time."""

import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from splitsafe.llm import common, decontam, quality, tokens

from .test_operators import ODD, SF, shingles


def one_of_each(rows):
    """(id, text) of the smallest id of every component of similar texts."""
    sets = {i: shingles(t) for i, t in rows}
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    return [(i, t) for i, t in rows if find(i) == i]


def without_repeats(rows):
    """Texts (lists of words, or the text where nothing is cut) without 50-word passages seen before; emptied ones go."""
    seen, out = {}, []
    for i, t in sorted(rows):
        w = [x for x in re.split(rb"[\x20\x09-\x0d]+", (t or "").encode()) if x]
        cut = set()
        for s in range(len(w) - 49):
            k = tuple(w[s:s + 50])
            if k in seen:
                j, q = seen[k]
                cut.update(range(q + 50 if j == i and s - q < 50 else s, s + 50))
            seen[k] = (i, s)
        kept = [x for n, x in enumerate(w) if n not in cut]
        if not cut or kept:
            out.append((i, t if not cut else b" ".join(kept).decode(), bool(cut)))
    return out


def words(t):
    return common.words_of(np.frombuffer((t or "").encode(), np.uint8), plain=True)[0]


def test_rows_are_those_of_the_stages(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    scored = quality.score(docs, quality.fit(docs, labels)).join(docs, "doc_id").collect()
    rows = [(r["doc_id"], r["text"]) for r in scored if r["predicted"] == 1]
    assert 0 < len(rows) < len(scored)
    rows = one_of_each(rows)
    rows = without_repeats(rows)
    items = [words(r["text"]) for r in common.table(spark, SF, "benchmark").collect()]

    def holds(t):
        w = words(t)
        for x in items:
            c = decontam.weights(x)
            if len(set(common.grams(w, 5).tolist()) & set(c)) >= len(c) // 2 and max(
                    decontam.weighted_similarity(c, decontam.weights(w[s:s + len(x)])) for s in range(len(w))) >= 0.75:
                return True
        return False

    rows = [(i, t, cut) for i, t, cut in rows if not holds(t)]
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == {i for i, *_ in rows}
    enc = tokens.encoder(tokens.default_tokenizer())
    for i, t, cut in rows:
        own = sorted(pieces[i], key=lambda r: r["start"])
        assert [r["start"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        assert sum(r["length"] for r in own) == own[0]["doc_tokens"]
        if not cut:     # the white space left around a cut is the stage's own
            ids = np.array(enc.tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
            assert [r["ids_crc32"] for r in own] == [zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in own]


def test_stages_keep_columns_and_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string").withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text"))
    for df in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, SF)
            assert name == "packing" or out.columns == docs.columns
            out.collect()
