"""The lookup of a category's entry: NULL and heavy categories never move."""

import pytest
from pyspark.sql import functions as F

from splitsafe.operators import encode


@pytest.fixture
def skewed(spark):
    i = F.col("id")
    cat = F.when(i % 3 == 0, F.lit(None)).when(i % 3 == 1, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000)))
    return spark.range(0, 60_000, numPartitions=8).select("id", cat.alias("cat"), (i % 2).alias("y"))


def expected(df, null_safe):
    rows = df.collect()
    sums = {}
    for r in rows:
        s, n = sums.get(r["cat"], (0, 0))
        sums[r["cat"]] = s + r["y"], n + 1
    return {r["id"]: sums[r["cat"]][0] / sums[r["cat"]][1] if null_safe or r["cat"] is not None else None for r in rows}


@pytest.mark.parametrize("null_safe", [False, True])
def test_equal_to_a_dictionary(spark, skewed, null_safe):
    for df in (skewed, skewed.where("cat = 7 or cat is null"), skewed.where("id % 3 = 2"), skewed.where("cat is null"), skewed.where("false")):
        got = encode.target_encode(df, "cat", "y", fallback=None, null_safe=null_safe)
        assert got.columns == ["id", "cat", "y", "encoded"]
        assert {r["id"]: r["encoded"] for r in got.collect()} == pytest.approx(expected(df, null_safe), nan_ok=True)


def test_unseen_categories_and_two_keys(spark, skewed):
    got = encode.target_encode(skewed, "cat", "y", where=F.col("id") < 30_000, name="e").agg(F.count("e"), F.count("*")).first()
    assert got[0] == got[1] == 60_000
    df = skewed.withColumn("other", F.when(F.col("id") % 2 == 0, F.lit("a")))
    want = df.groupBy("cat", "other").agg(F.avg("y").alias("w"))
    both = encode.target_encode(df, ["cat", "other"], "y", fallback=None, null_safe=True)
    bad = both.join(want, both["cat"].eqNullSafe(want["cat"]) & both["other"].eqNullSafe(want["other"])).where("not (encoded <=> w)")
    assert both.count() == 60_000 and bad.count() == 0


def test_more_categories_than_the_sketch_holds(spark):
    df = spark.range(0, 300_000, numPartitions=8).select("id", F.when(F.col("id") % 4 == 0, 5).otherwise(F.pmod("id", F.lit(140_000))).alias("cat"), (F.col("id") % 2).alias("y"))
    want = df.groupBy("cat").agg(F.avg("y").alias("w"))
    got = encode.target_encode(df, "cat", "y", fallback=None)
    assert got.join(want, "cat").where("encoded <=> w").count() == got.count() == 300_000


def test_no_large_task_and_no_large_broadcast(spark, skewed):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = encode.target_encode(skewed, "cat", "y", fallback=None)
        sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sum(sizes) == 60_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
