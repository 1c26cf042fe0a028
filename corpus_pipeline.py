"""A training corpus from ``documents``: quality filter, near duplicates, repeated passages, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept, and returns the columns of
``documents``; the last returns one row a packed piece. ``run`` writes each stage's rows to the shared folder and
hands the table read again to the next. No SQL expresses the stages, so ``ORACLE_SQL`` is None; a test compares
the rows of ``run`` over a small table with the stages worked out one document at a time.

Rows with null or empty text have a score like others, form no near-duplicate group, hold no passage or item, and pack
as their end id. A null id is carried along (and never learned from). Rows that share an id are documents of their
own; of equal texts the smallest id stays. Ties follow the id. An empty table passes every stage and gives no pieces.
Very long texts are read whole, in memory of a small multiple of their size. Extra columns go through all stages but
the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from splitsafe.llm import common, decontam, jaccard_join, packing, quality, suffix_dedup, tokens
from splitsafe.llm.queries import pieces_digest


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.3 or more)."""
    return quality.accepted(docs, quality.fit(docs, common.table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of 5-word shingle sets with a Jaccard similarity of 0.75 or more."""
    return jaccard_join.distinct(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that occurred before are cut; ``n_chars`` follows the text."""
    out = suffix_dedup.dedup(docs)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, common.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 2048 tokens, written (seven numbers a piece) while texts go to Python in small batches."""
    return common.written(pieces_digest(packing.pack(docs, tokens.default_tokenizer())), "pieces")


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = common.new_folder(spark, name)
        rows = stage(spark, docs, sf_dir)
        with common.frugal(spark):
            rows.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
