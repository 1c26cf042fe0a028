"""The training-data operators against brute force, exact round trips and held-out accuracy, and on odd rows."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from splitsafe.llm import ann, common, decontam, html_extract, jaccard_join, langid, packing, quality, suffix_dedup, token_files, tokens, warc

SF = "/root/testdata/sf0.001"
ODD = [(1, "one two three four five six seven", "en"), (1, "one two three four five six seven", "en"), (2, None, None), (3, "", "en"),
       (None, "one two three four five six seven", "de"), (4, "  \t\n ", None), (5, "word " * 30000, "en"), (6, "é漢字 <|endoftext|> x", "fr")]
DOCS = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    return common.table(spark, SF, "documents").cache()


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, DOCS)
    from pyspark.sql import functions as F
    return df.withColumn("node", F.lit("x")).withColumn("h", F.lit(1)).withColumn("ids", F.lit(2)).withColumn("score", F.lit(0))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("path", [tokens.default_tokenizer(), tokens.word_tokenizer()])
def test_ids_are_the_librarys(path):
    enc = tokens.Encoder(path)
    texts = ["a  b", " x", "y ", "a\n\nb", "a \nb", "a\n b", "<|endoftext|> hi", "it's we'll\nI'm", "x\u00a0y", "", None, "\n", "a\tb", "word,. b", "\u00e9,\u00e8! \u00f9?", "a b\nc d"]
    rng = random.Random(3)
    parts = [*"ab cS'\n\t\r\x0b\x1c1.,\u00a0\u00e9\u0301\u3000\u00c9\u03a3\u0130\ud55c\ufb01", "<|endoftext|>", "'s", "  ", "the "]
    texts += ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(5000)]
    column = pa.array(texts)
    for chunk in (column, column.slice(7, 100), column.cast(pa.large_string())):
        ids, ends = enc.encode(chunk)
        found = np.split(ids, ends[:-1])
        assert len(ids) == ends[-1]
        for t, x in zip(chunk.to_pylist(), found):
            assert x.tolist() == (enc.tokenizer.encode(t, add_special_tokens=False).ids if t else [])
    assert enc.encode(pa.array([None, ""], pa.string()))[1].tolist() == [0, 0]
    assert [len(c) for c in tokens.row_chunks(column, 200)] and sum(len(c) for c in tokens.row_chunks(column, 200)) == len(texts)


def test_token_files_round_trip(spark, docs, odd, none):
    enc = tokens.encoder(tokens.default_tokenizer())
    for df in (docs, odd, none):
        folder = common.new_folder(spark, "t")
        token_files.write(df, folder, tokens.default_tokenizer())
        got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["ids"]), r["start"], r["n_tokens"]) for r in token_files.read(spark, folder).collect()), key=lambda r: r[3])
        want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, np.array(enc.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4").tobytes()) for r in df.collect())
        assert sorted(g[:3] for g in got) == want
        assert [g[:2] for g in got] == sorted(g[:2] for g in got)
        assert [g[3] for g in got] == [int(x) for x in np.cumsum([0] + [g[4] for g in got])[:-1]]


def test_packing_is_whole_and_full(docs, odd, none):
    for df in (docs, odd):
        rows = packing.pack(df, tokens.default_tokenizer(), length=256).collect()
        by_seq, total = defaultdict(list), 0
        for r in rows:
            by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
            total += r["length"]
            assert len(r["ids"]) == 4 * r["length"]
        for pieces in by_seq.values():
            at = 0
            for o, n in sorted(pieces):
                assert o == at
                at += n
            assert at <= 256 and at & (at - 1) == 0
        enc = tokens.encoder(tokens.default_tokenizer())
        assert total == sum(len(enc.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in df.collect())
    assert packing.pack(none, tokens.default_tokenizer()).count() == 0


def test_packing_balances_cost():
    sizes = np.random.default_rng(1).integers(1, 900, 400)
    cost, fill = defaultdict(float), defaultdict(int)
    for _, _, n, s, _ in packing.assign(sizes, 1000, 1.0, 1 / 1000):
        cost[s] += n + n * n / 1000
        fill[s] += n
    full = [cost[s] for s in fill if fill[s] == 1000]
    assert sum(fill.values()) == sizes.sum() and np.std(full) / np.mean(full) < 0.12


def test_warc_round_trip_and_salvage(spark, tmp_path):
    big = "<p>" + "x" * 1200
    rows = [(1, "u", big), (2, "u", big), (3, None, "small"), (4, "a b", "small"), (5, "u", None), (None, "u", big), (2, "u", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for packed in (True, False):
        files = warc.write(df, common.new_folder(spark, "w"), compress=packed)
        got = sorted((str(warc_id(r["record_id"])), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read(files).collect())
        assert got == sorted([("1", "revisit", "<urn:x-page:2>", 1203), ("2", "response", None, 1203), ("2", "response", None, 1203), ("3", "response", None, 5),
                              ("4", "response", None, 5), ("5", "response", None, 0), ("None", "response", None, 1203)])
        assert warc.gaps(files).count() == 0
    assert warc.read(warc.write(df.limit(0), common.new_folder(spark, "w"))).count() == 0


def warc_id(uri):
    x = re.fullmatch(r"<urn:x-page:(-?\d+|null)>", uri)[1]
    return None if x == "null" else int(x)


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_skips_damage(packed):
    recs = [warc.record_bytes(i, "u", f"payload {i}".encode() * 50, __import__("hashlib").sha1(f"payload {i}".encode() * 50).hexdigest(), None) for i in range(6)]
    parts = [warc.gzip_member(r) for r in recs] if packed else recs
    bad = bytearray(parts[2])
    bad[len(bad) // 2] ^= 0xFF
    cut = parts[4][:len(parts[4]) // 2]
    data = b"".join([parts[0], parts[1], bytes(bad), parts[3], cut, parts[5]])
    out = list(warc.salvage(data, "f"))
    assert [warc_id(r["record_id"]) for k, r in out if k == "record"] == [0, 1, 3, 5]
    gaps = [(r["at"], r["bytes"]) for k, r in out if k == "gap"]
    assert gaps == [(len(parts[0]) + len(parts[1]), len(bad)), (sum(map(len, parts[:4])), len(cut))]
    assert [r["bytes"] for k, r in warc.salvage(b"junk", "f") if k == "gap"] == [4] and not list(warc.salvage(b""))


def shingles(text):
    w = [x for x in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_jaccard_join_is_brute_force(spark):
    rng = np.random.default_rng(4)
    rows, base = [], [" ".join(f"w{x}" for x in rng.integers(0, 400, n)) for n in (12, 40, 80, 200)]
    passage = " ".join(f"p{i}" for i in range(60))
    for i in range(160):
        w = base[i % 4].split()
        for _ in range(rng.integers(0, 4)):
            w[rng.integers(0, len(w))] = f"e{rng.integers(0, 50)}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, f"{passage} " + " ".join(f"z{x}" for x in rng.integers(0, 5000, 50 + i))) for i in range(60)]
    rows += [(300, None), (301, ""), (302, "a b"), (303, "A  b"), (304, "a")]
    sets = {i: shingles(t) for i, t in rows}
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(df).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in sets}
    kept = {r["doc_id"] for r in jaccard_join.distinct(df).collect()}
    assert kept == {i for i in sets if find(i) == i}


def test_jaccard_join_odd_rows(odd, none):
    assert jaccard_join.join(odd).count() == len(ODD) and jaccard_join.join(none).count() == 0
    got = sorted((r["doc_id"] or 0) for r in jaccard_join.distinct(odd).collect())
    assert got == [0, 1, 2, 3, 4, 5, 6]


def test_suffix_dedup_is_brute_force(spark, docs):
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    seen, want = {}, {}
    for i, t in rows:
        w = [x for x in re.split(rb"[\x20\x09-\x0d]+", t.encode()) if x]
        cut = set()
        for s in range(len(w) - 49):
            k = tuple(w[s:s + 50])
            if k in seen:
                j, q = seen[k]
                cut.update(range(q + 50 if j == i and s - q < 50 else s, s + 50))
            seen[k] = (i, s)
        if cut:
            want[i] = (cut, [x for n, x in enumerate(w) if n not in cut])
    got = {r["doc_id"]: {x for c in r["cuts"] for x in range(c["from"], c["to"])} for r in suffix_dedup.spans(suffix_dedup.repeats(docs)).collect()}
    assert got == {i: c for i, (c, _) in want.items()} and got
    after = {r["doc_id"]: r["text"] for r in suffix_dedup.dedup(docs).collect()}
    for i, t in rows:
        if i not in want:
            assert after[i] == t
        elif want[i][1]:
            assert after[i].encode().split() == want[i][1]
        else:
            assert i not in after


def test_suffix_dedup_odd_rows(odd, none):
    out = suffix_dedup.dedup(odd)
    assert out.count() == len(ODD) and out.columns == odd.columns
    assert len(next(r["text"] for r in out.collect() if r["doc_id"] == 5).split()) == 50
    assert suffix_dedup.dedup(none).count() == 0


def test_decontamination_is_brute_force(spark, docs):
    bench = common.table(spark, SF, "benchmark")
    words = lambda t: common.words_of(np.frombuffer((t or "").encode(), np.uint8), plain=True)[0]
    items = {r["item_id"]: words(r["text"]) for r in bench.collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    item = bench.orderBy("item_id").first()["text"].split()
    half = item[:]
    half[len(half) // 2] = "changed"
    rows += [(10_000, "x y z " + " ".join(item).upper() + " tail"), (10_001, " ".join(f"q{i}" for i in range(90)))]
    want = set()
    for i, t in rows:
        w = words(t)
        for k, x in items.items():
            c = decontam.weights(x)
            if len(w) and len(set(common.grams(w, 5).tolist()) & set(c)) >= len(c) // 2:
                if max(decontam.weighted_similarity(c, decontam.weights(w[s:s + len(x)])) for s in range(len(w))) >= 0.75:
                    want.add((i, k))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.find(df, bench).collect()} == want and any(i == 10_000 for i, _ in want)
    assert {r["doc_id"] for r in decontam.clean(df, bench).collect()} == {i for i, _ in rows} - {i for i, _ in want}


def test_decontamination_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, None), (None, "x"), (2, ""), (3, "one two three four five six seven"), (4, "x")], "item_id long, text string")
    got = sorted((r["doc_id"] or 0, r["item_id"]) for r in decontam.find(odd, bench).collect())
    assert got == [(0, 3), (1, 3), (1, 3), (6, 4)]
    assert decontam.find(none, bench).count() == 0 and decontam.find(odd, bench.limit(0)).count() == 0 and decontam.clean(odd, bench.limit(0)).count() == len(ODD)


def test_quality_and_language_learn(spark, odd, none):
    sf = "/root/testdata/sf0.01"
    d, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    model = quality.fit(d, labels)
    rows = quality.score(d, model).join(labels, "doc_id").where("held_out and quality is not null").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.9
    assert quality.score(odd, model).count() == len(ODD) and quality.score(none, model).count() == 0
    assert all(r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in quality.score(odd, model).collect())
    assert {r["score"] for r in quality.score(odd, quality.fit(none, labels)).collect()} == {0.5}
    lang = langid.fit(d)
    rows = langid.predict(d, lang).join(d, "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.95
    assert [r["lang_pred"] for r in langid.predict(odd, lang).collect() if r["doc_id"] in (2, 3, 4)] == ["und"] * 3
    assert {r["lang_pred"] for r in langid.predict(odd, langid.fit(none)).collect()} == {"und"}


def test_page_text():
    field = html_extract.train()
    held = html_extract.labelled_pages(150, seed=77)
    ok = [a == b for x, y in held for a, b in zip(y, field.decode(x))]
    assert sum(ok) / len(ok) > 0.98
    page = ("<html><head><title>T</title><script>var t='</p>'</script></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>"
            "<article><h1>Big &amp; news</h1><p><b>First   part\n here.<br><p>Second &eacute; paragraph, with more words in it.</article><footer>&copy; me</footer>")
    assert html_extract.main_text(page, field) == "Big & news\nFirst part here.\nSecond é paragraph, with more words in it."
    assert html_extract.main_text(None, field) == "" and html_extract.main_text("<scr", field) == ""


def test_neighbours_recall(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(700, 16)).astype(np.float32)
    v[100:400] = v[100]  # a third of the rows are one vector
    rows = [(i, v[i].tolist(), 1) for i in range(700)] + [(900, None, 1), (950, [0.0] * 16, 1), (1000, [float("nan")] * 16, 1), (1001, [1.0, None] + [0.0] * 14, 1), (None, v[3].tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = defaultdict(list)
    for r in ann.nearest(df).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    hit = 0
    for q in range(0, 700, 50):
        s = np.round(u @ u[q], 12)
        s[q] = -9
        best = np.lexsort((np.arange(700), -s))[:5].tolist()
        hit += len(set(best) & set(got[q]))
        assert len(got[q]) == 5
    assert set(got) == set(range(0, 700, 50)) and hit / (5 * 14) >= 0.9
    assert got[150] == [100, 101, 102, 103, 104]
    assert ann.nearest(df.limit(0)).count() == 0


def test_pipeline_runs(spark):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "decontamination", "packing"]
