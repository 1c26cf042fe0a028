"""Inputs on which results were once lost: long headers, number forms, formulas, odd script ends and comments."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from splitsafe.llm import common, html_extract, langid, warc

PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize("compress", [True, False])
def test_header_of_any_length(spark, compress):
    rows = [(1, "https://x.org/" + "a" * 70_000, "<p>one</p>"), (2, "https://x.org/" + "é\n" * 60_000, "two " * 400), (3, "u", "two " * 400)]
    files = warc.write(spark.createDataFrame(rows, PAGES).coalesce(1), common.new_folder(spark, "warc"), compress=compress)
    got = {r["record_id"]: (r["record_type"], r["payload_bytes"], len(r["uri"])) for r in warc.read(files).collect()}
    assert got == {"<urn:x-page:1>": ("response", 10, 70_014), "<urn:x-page:2>": ("revisit", 1600, 14 + 60_000 + 3 * 60_000), "<urn:x-page:3>": ("response", 1600, 1)}


@pytest.mark.parametrize("compress", [True, False])
def test_salvage_behind_a_damaged_long_header(compress):
    records = [warc.record_bytes(i, "u" * n, b"payload %d" % i, warc.hashlib.sha1(b"payload %d" % i).hexdigest(), None) for i, n in ((1, 90_000), (2, 100_000), (3, 5))]
    records[1] = records[1].replace(b"Content-Length: ", b"Content-Length? ")
    data = b"".join(warc.gzip_member(r) if compress else r for r in records)
    found = list(warc.salvage(data))
    assert [r["record_id"] for k, r in found if k == "record"] == ["<urn:x-page:1>", "<urn:x-page:3>"]
    assert sum(k == "gap" for k, _ in found) >= 1


def test_only_letters_make_a_language(spark):
    texts = ["½ ² ①", "Ⅷ ⅷ", "१२ 12", "_ - _", "a", "ª", "日", None]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(df, langid.fit(df.unionAll(df.where("doc_id = 4").withColumn("doc_id", F.lit(100))))).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 7)] == ["und"] * 5 and "und" not in [got[i] for i in (4, 5, 6)]


@pytest.mark.parametrize("page,blocks", [
    ("<p>Let <math><mi>x</mi><mo>=</mo><mspace/><mn>1</mn><annotation>x=1</annotation></math> be so.</p>", ["Let x=1 be so."]),
    ("<p>One</p><script>var a</script x><p>Two</p><script>b</script/><p>Three</p>", ["One", "Two", "Three"]),
    ("<p>One<!--></p><p>Two<!---></p><p>Three<!-- x --!>, four", ["One", "Two", "Three, four"]),
    ("<p>One</p><script src=a.js/>var q=1;</script><p>Two</p>", ["One", "Two"]),
    ("<p>An <object data=x>inner</object> word <svg viewBox='0'/> more <svg><text>no</text></svg></p>", ["An inner word", "more"]),
    ("<a href=https://x.org/>A link</a> and words", ["A link and words"])])
def test_blocks_of_odd_markup(page, blocks):
    assert [b.text for b in html_extract.blocks(page)] == blocks


def test_extract_on_odd_rows(spark):
    """The operator as Spark runs it: nulls, repeated rows, no pages, long texts, names that clash."""
    field = html_extract.train()
    body = "<article><p>" + "A sentence, with several plain words in it. " * 6 + "</p></article>"
    long = "<article>" + "<p>Many words stand here, one after the other, on and on.</p>" * 20_000 + "</article>"
    rows = [(1, "u", body), (1, "u", body), (2, None, None), (None, "v", body), (3, "w", ""), (4, "x", "   "), (5, "y", long)]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as text", "2 as n_chars", "3 as id")
    got = sorted(html_extract.extract(df, field).select("page_id", "url", "text", "n_chars").collect(), key=repr)
    want = sorted(((p, u, html_extract.main_text(h, field)) for p, u, h in rows), key=repr)
    assert [(r["page_id"], r["url"], r["text"]) for r in got] == want and all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_extract.extract(df.where("false"), field).count() == 0
