"""The range of keys of a table with copies comes from the table itself, not from the sampled copies."""

from pyspark.sql import functions as F

from splitsafe.operators import experiments


def test_copies_are_not_made_for_the_range_of_keys(spark):
    rows = spark.createDataFrame([(1,), (1 << 61,)], "k long")
    copies = rows.withColumn("copy_no", F.raise_error(F.lit("read")).cast("int"))
    both = rows.withColumn("copy_no", F.lit(0)).unionByName(rows.where("k = 1").withColumn("copy_no", F.lit(1)))
    key = experiments.copy_key(copies.where("copy_no = 1"), "k", of=rows)
    assert sorted(r[0] for r in both.select(key).collect()) == [2, 3, 1 << 62]
    wide = spark.createDataFrame([(1 << 62,)], "k long").withColumn("copy_no", F.lit(1))
    assert int(wide.select(experiments.copy_key(wide, "k", of=wide)).first()[0]) == (1 << 63) + 1
