"""Registered queries of the ten operators, with production parameters over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import ann, bestfit, common, decontam, html_extract, jaccard_join, langid, packing, periodic, quality, search, suffix_dedup, token_files, tokens, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.new_folder(spark, "tokens")
    token_files.write(common.table(spark, sf_dir, "documents"), folder, tokens.default_tokenizer(), end_id=0)
    return token_files.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def pieces_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_digest(packing.pack(common.table(spark, sf_dir, "documents"), tokens.default_tokenizer()))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write(common.table(spark, sf_dir, "pages"), common.new_folder(spark, "warc"))
    return warc.read(files).select(warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                                   "record_type", warc.page_of("refers_to").alias("refers_to"))


ORACLES["op7_warc"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, payload_bytes, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.top > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.top > p.page_id THEN f.top END AS refers_to
FROM p LEFT JOIN f USING (payload_digest, payload_bytes)"""


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.join(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, common.table(spark, sf_dir, "labels")))


@query
def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


@query
def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(common.table(spark, sf_dir, "pages"), html_extract.train())


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with repeated passages: how many words they hold, and each with a document that has it before.

    Passages shared with different documents may overlap; ``repeated_words`` counts each word once.
    """
    cuts = suffix_dedup.spans(suffix_dedup.repeats(common.table(spark, sf_dir, "documents")))
    return cuts.select("doc_id", F.aggregate("cuts", F.lit(0), lambda n, c: n + c["to"] - c["from"]).cast("long").alias("repeated_words"),
                       F.expr("transform(passages, c -> struct(c.`from` as first_word, c.`to` - c.`from` as n_words, c.other as other_doc_id))").alias("passages"))


@query
def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


@query
def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(common.table(spark, sf_dir, "embeddings"))


@query
def op13_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = bestfit.pack(common.table(spark, sf_dir, "documents"), tokens.word_tokenizer())
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"), k=20)


def _terms_sql(text: str) -> str:
    lower = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"unnest(regexp_extract_all({lower}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'))"


ORACLES["op12_lexical_search"] = f"""
WITH t AS (SELECT doc_id, {_terms_sql("text")} AS term FROM documents),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * c.docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, c GROUP BY term, c.docs),
p AS (SELECT tf.doc_id, tf.term, w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * n.n * c.docs) // c.terms))) AS impact
      FROM tf JOIN n USING (doc_id) JOIN w USING (term), c),
q AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, {_terms_sql("text")} AS term FROM benchmark) GROUP BY item_id, term),
s AS (SELECT q.item_id, p.doc_id, CAST(sum(q.repeats * p.impact) AS BIGINT) AS score FROM q JOIN p USING (term) GROUP BY q.item_id, p.doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20"""


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, where of a tenth of the documents (h % 10 = 0, h = crc32 of the id) the words from a = g % n on
    repeat the first p = 1 + (n - a) div (3 + g % 8) of them, g = h div 10, n words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), h.alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")).alias("ws")
    rows = rows.select("doc_id", "text", F.expr("h div 10").alias("g"), words).withColumn("n", F.size("ws"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    text = F.expr("""array_join(concat(slice(ws, 1, a),
                     slice(flatten(array_repeat(slice(ws, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)), ' ')""")
    return rows.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def periodic_digest(docs: DataFrame) -> DataFrame:
    found = periodic.find(with_planted_repeats(docs))
    top = F.expr("""aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), runs[0],
                              (best, r) -> if(r.length * best.period > best.length * r.period, r, best))""")
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'), '')")
    found = found.withColumn("top", F.when(F.size("runs") > 0, top))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
                        F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_digest(common.table(spark, sf_dir, "documents"))
