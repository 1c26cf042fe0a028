"""Faults of round 1: exact counts, NULL order values, quoted CSV, null-safe identity, checkpoint folder."""

import math

from pyspark.sql import functions as F

from splitsafe.operators import encode, metrics, profile, split
from splitsafe.session import cut_lineage
from splitsafe.sources import csv


def test_distinct_counts_are_exact(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("a"), (F.col("id") % 480).cast("string").alias("b"), F.lit(None).cast("string").alias("c"))
    got = {r["column"]: (r["n_distinct"], r["exact"]) for r in profile.distinct_counts(df, ["a", "b", "c"]).collect()}
    assert got == {"a": (5000, True), "b": (480, True), "c": (0, True)}


def test_null_order_values_get_no_split(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 50, F.col("id")).alias("t"))
    got = {r["split"]: r["count"] for r in split.temporal_split(df, ["t"], 0.8).groupBy("split").count().collect()}
    assert got == {"train": 40, "test": 10, None: 50}


def test_csv_quotes_lines_and_codes(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b,c,d\n1,"x, y",12D,1.5\n2,"say ""hi""",34F,NA\n3,"two\nlines",5D,2e3\n')
    df = csv.read_table(spark, f"file://{path}", multi_line=True)
    assert [tuple(r) for r in df.orderBy("a").collect()] == [(1, "x, y", "12D", 1.5), (2, 'say "hi"', "34F", None), (3, "two\nlines", "5D", 2000.0)]
    assert dict(df.dtypes) == {"a": "bigint", "b": "string", "c": "string", "d": "double"}


def test_null_safe_encoding(spark):
    df = spark.createDataFrame([(1, None, 1.0, "train"), (1, None, 0.0, "train"), (2, None, 1.0, "train"), (1, None, 0.0, "test")], "a int, b int, y double, split string")
    got = encode.target_encode(df, ["a", "b"], "y", F.col("split") == "train", name="s", null_safe=True)
    assert [r["s"] for r in got.where("split = 'test'").collect()] == [0.5]


def test_auc_of_many_scores(spark):
    df = spark.range(20000).select((F.col("id") * 7919 % 20011).alias("s"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    p = df.toPandas()
    r = p["s"].rank()
    n, m = (p.y == 1).sum(), (p.y == 0).sum()
    want = (r[p.y == 1].sum() - n * (n + 1) / 2) / (n * m)
    assert abs(metrics.roc_auc(df, "s", "y").first()["auc"] - want) < 1e-12


def test_checkpoint_folder_is_kept(spark, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    cut_lineage(spark.range(3))
    assert spark.sparkContext.getCheckpointDir() == before and before


def test_selection_of_heavy_tails_and_distant_ranks(spark):
    from splitsafe.operators import rank
    vals = sorted([math.copysign(10.0 ** (i % 601 - 300), i % 7 - 3) * (1 + i / 9000) for i in range(9000)]
                  + [math.inf, -math.inf] + [5.0] * 3000)
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    ks = [0, 1, 700, 6000, 11_000, len(vals) - 1]
    got = {r["k"]: (r["value"], r["n_less"]) for r in
           rank.select_kth(df, "x", [{"k": k} for k in ks], max_exact=50, n_buckets=16).collect()}
    assert got == {k: (vals[k], vals.index(vals[k])) for k in ks}


def test_order_of_64_bit_keys(spark):
    df = spark.range(1000).select(((F.col("id") - 500) + (1 << 60)).alias("k"), F.col("id"))
    out = split.temporal_split(df, ["k"], frac=0.8).collect()
    assert all((r["split"] == "train") == (r["id"] < 800) for r in out)
    assert split.sample_rows(df, "k", n=123).count() == 123
    low = spark.range(100).select((F.col("id") - 50).alias("k"))
    assert sorted(r["k"] for r in split.temporal_split(low, ["k"], frac=0.3).where("split = 'train'").collect()) == list(range(-50, -20))
