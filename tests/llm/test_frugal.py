"""What the joins leave on disk, and how much of a table is moved to Python at once."""

import os
from urllib.parse import unquote

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from splitsafe.llm import common, jaccard_join, suffix_dedup
from tests.conftest import SF01


@pytest.fixture
def shared(tmp_path, monkeypatch):
    folder = tmp_path / "a folder"
    monkeypatch.setattr(common, "shared_dir", lambda spark: f"file://{folder}")
    return lambda: sorted(f.split("-")[1] for f in os.listdir(folder))


def test_suffix_dedup_keeps_only_what_is_read_later(spark, shared):
    docs = common.table(spark, SF01, "documents")
    found = suffix_dedup.repeats(docs)
    assert shared() == ["repeats"] and found.count() > 0
    # hashes stay with the edge rows alone
    kept = spark.read.parquet(unquote(found.inputFiles()[0]).rsplit("/", 1)[0])
    assert kept.where("not edge and (g is not null or h is not null)").count() == 0 and kept.where("edge and g is null").count() == 0
    suffix_dedup.dedup(docs)
    assert shared() == ["cuts", "repeats"]


def test_jaccard_join_keeps_only_what_is_read_later(spark, shared):
    rows = jaccard_join.join(common.table(spark, SF01, "documents"))
    assert shared() == ["base", "nodes"] and rows.count() == 1000


def test_prefixes_are_shuffled_in_slices(spark, shared, monkeypatch):
    """Any number of slices finds the same components."""
    docs = common.table(spark, SF01, "documents")
    rows = lambda: {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.join(docs).collect()}
    found = rows()
    assert shared().count("postings") == 0
    monkeypatch.setattr(jaccard_join, "SLICES", 1)
    assert rows() == found


def test_writes_leave_no_shuffle_files(spark):
    def files():
        root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in root for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    before = files()
    common.written(spark.range(10_000).repartition(7, "id"), "numbers")
    assert files() <= before


def test_long_texts_come_in_batches_of_bounded_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    docs = spark.range(3000, numPartitions=1).select(F.repeat(F.lit("word "), 2000).alias("text"))
    got = common.written(docs.mapInArrow(sizes, "n long, bytes long"), "sizes").agg(F.max("bytes").alias("most"), F.sum("n").alias("n")).first()
    assert got["most"] < 2 * common.BATCH_BYTES and got["n"] == 3000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_only_own_folders_are_released(spark):
    with pytest.raises(ValueError):
        common.release(spark.read.parquet(f"{SF01}/documents.parquet"))
