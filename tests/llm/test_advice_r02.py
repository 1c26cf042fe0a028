
import re
import zlib

import numpy as np

from splitsafe.llm import common, html_extract, langid, quality, suffix_dedup

SF = "/root/testdata/sf0.001"


def some_words(tag, n):
    return [f"{tag}{i}" for i in range(n)]


def is_run(part, words):
    return any(words[k:k + len(part)] == part for k in range(len(words) - len(part) + 1))


def test_every_partner_of_a_passage_is_reported(spark):
    lead, body, q = some_words("l", 60), some_words("b", 120), some_words("q", 70)
    texts = {2: some_words("m", 30) + q, 5: some_words("k", 10) + body, 7: lead + some_words("n", 30),
             9: lead + body[:60] + q + body[60:], 11: body[60:] + body[:60]}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r for r in suffix_dedup.spans(suffix_dedup.repeats(df)).collect()}
    partners = {(c["from"], c["to"], c["other"]) for c in got[9]["passages"]}
    assert partners == {(0, 60, 7), (60, 120, 5), (120, 190, 2), (190, 250, 5)}
    assert [(c["from"], c["to"]) for c in got[9]["cuts"]] == [(0, 250)]
    assert {(c["from"], c["to"], c["other"]) for c in got[11]["passages"]} == {(0, 60, 9), (60, 120, 9)}  # no run of 120 words stands in 9


def test_passages_stand_in_their_partners(spark):
    docs = common.table(spark, SF, "documents")
    words = {r["doc_id"]: [x for x in re.split(rb"[\x20\x09-\x0d]+", (r["text"] or "").encode()) if x] for r in docs.collect()}
    got = suffix_dedup.spans(suffix_dedup.repeats(docs)).collect()
    seen, want = {}, set()
    for i in sorted(words):
        for s in range(len(words[i]) - 49):
            k = tuple(words[i][s:s + 50])
            if k in seen:
                want.add((i, s, seen[k][0]))
            seen[k] = (i, s)
    assert got and want
    for r in got:
        for c in r["passages"]:
            assert is_run(words[r["doc_id"]][c["from"]:c["to"]], words[c["other"]])
        of_cuts = {x for c in r["cuts"] for x in range(c["from"], c["to"])}
        assert of_cuts == {x for c in r["passages"] for x in range(c["from"], c["to"])}
    # tasks' first rows name their key's least occurrence, all others the nearest: either way one that is earlier
    linked = {(r["doc_id"], c["other"]) for r in got for c in r["passages"]}
    assert all(j <= i for i, j in linked) and {i for i, _ in linked} == {i for i, _, _ in want}
    assert len({(i, j) for i, _, j in want} - linked) <= 8 * 2  # at most the edge rows of eight tasks


def test_long_texts_do_not_end_the_language_sample(spark):
    words = {"aa": "alpha beta gamma delta", "bb": "uno dos tres cuatro", "cc": "jeden dwa trzy cztery"}
    rows = [(i, f"{words['aa']} {i}", "aa") for i in range(400)] + [(i, f"{words['bb']} {i}", "bb") for i in range(400, 430)]
    rows += [(i, "zz " * 500_000 + words["cc"], "cc") for i in range(430, 445)]  # 22 million characters of one language
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    seen = []
    fitted = langid.Model.fit
    try:
        langid.Model.fit = lambda self, rows, y, check: seen.append((list(y), list(check))) or fitted(self, rows, y, check)
        model = langid.fit(df, per_language=40)
    finally:
        langid.Model.fit = fitted
    learned = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5]
    sizes = [len([i for i in learned if lo <= i < hi]) for lo, hi in ((0, 400), (400, 430), (430, 445))]
    y, check = seen[0]
    assert [y.count(k) for k in range(3)] == [40, sizes[1], sizes[2]]
    assert [sum(c for c, k in zip(check, y) if k == j) for j in range(3)] == [8, sizes[1] // 5, sizes[2] // 5]
    assert model.predict("tres cuatro uno")[0] == "bb" and model.predict("zz zz zz dwa trzy")[0] == "cc"


def test_a_long_text_does_not_end_the_quality_sample(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, "A fine sentence, with care." if i % 2 else "buy buy now !!! $$$") for i in ids]
    first = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "xxhash64(doc_id) h").orderBy("h").first()["doc_id"]
    rows = [(i, t + " x" * 8_100_000 if i == first else t) for i, t in rows]  # above 16 million characters, and first by hash
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    model = quality.fit(df, labels)
    assert model.prior is None
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in quality.score(df, model).collect()) >= len(ids) - 1


def test_contexts_are_those_of_each_text(spark, monkeypatch):
    monkeypatch.setattr(quality, "FLUSH", 7)
    texts = ["a b c d e f g h i", "", "x", "b a, b! c 12", "q w e r t y u i o p a s d f"]
    pos, sign = quality._hashed()
    want = np.zeros((quality.BUCKETS, quality.DIM))
    for t in texts:
        ids = [k for w in t.split() for k in quality.Chunks()[w] if k >= quality.SHAPES]
        for i, a in enumerate(ids):
            for b in ids[max(0, i - quality.WINDOW):i] + ids[i + 1:i + 1 + quality.WINDOW]:
                np.add.at(want[a], pos[b], sign[b])
    own = quality.Contexts()
    for t in texts:
        own.add(t)
    assert (own.sums() == want).all()
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    assert (quality.contexts(df) == want).all()


def test_an_open_head_ends_at_the_first_tag_or_text_of_the_body():
    for rest in ("<h1>News</h1><p>Some words.", "<p>News<p>Some words.", "News<p>Some words.", "<b>News</b><p>Some words."):
        page = "<html><head> <title>T</title>\n<meta charset=utf-8><style>p {}</style><script>var t</script>" + rest
        assert [b.text for b in html_extract.blocks(page)] == ["News", "Some words."]
    assert [b.text for b in html_extract.blocks("<head><title>T</title></head><body><p>x")] == ["x"]
