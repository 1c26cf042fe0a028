"""Test stand-in for the loan-application table (built with ``spark.range`` and md5 uniforms).

Columns as in the audited workflow plus boundary columns: one 60 % null column, one
exactly 45 % null column, a constant, a 100-value and a 99-value category, an
application date, repeated ids for 20 % of ids, 1 % exact duplicate rows and a label
from a logistic model of EXT_SOURCE_2/3 with roughly 8 % positives.
"""

from pyspark.sql import functions as F

from splitsafe.functions.hashing import hash_uniform


def loan_apps(spark, n: int = 4000, seed: int = 7):
    i = F.col("id")

    def u(tag):
        return hash_uniform(seed, i, F.lit(tag))

    base = spark.range(n).select(
        i.alias("row"),
        F.when(i < n * 0.4, F.lit(100000) + (i / 2).cast("long")).otherwise(F.lit(100000) + i).alias("SK_ID_CURR"),
        u("e2").alias("EXT_SOURCE_2"),
        F.when(u("e3n") > 0.2, u("e3")).alias("EXT_SOURCE_3"),
        F.when(u("edn") > 0.05, F.element_at(F.array(*[F.lit(x) for x in
               ["Secondary", "Higher", "Incomplete", "Lower", "Academic"]]),
               (F.floor(u("ed") * 5) + 1).cast("int"))).alias("NAME_EDUCATION_TYPE"),
        (F.lit(100000.0) + u("cr") * 900000).alias("AMT_CREDIT"),
        F.when(u("inn") > 0.02, F.lit(30000.0) + u("in") * 200000).alias("AMT_INCOME_TOTAL"),
        (F.lit(5000.0) + u("an") * 40000).alias("AMT_ANNUITY"),
        (-(F.lit(7000) + F.floor(u("db") * 18000))).cast("long").alias("DAYS_BIRTH"),
        F.when(u("des") < 0.05, F.lit(365243)).otherwise(-F.floor(u("de") * 10000)).cast("long")
         .alias("DAYS_EMPLOYED"),
        F.when(u("mn") > 0.6, u("m")).alias("MOSTLY_NULL"),
        F.when(F.pmod(i, F.lit(20)) >= 9, u("h")).alias("HALF_NULL"),
        F.lit(1.0).alias("CONSTANT"),
        F.concat(F.lit("c"), F.pmod(i, F.lit(100)).cast("string")).alias("CAT100"),
        F.concat(F.lit("k"), F.pmod(i, F.lit(99)).cast("string")).alias("CAT99"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.floor(u("dt") * 700).cast("int")).alias("app_date"),
    )
    logit = F.lit(-1.2) - 3.0 * F.col("EXT_SOURCE_2") - 2.0 * F.coalesce(F.col("EXT_SOURCE_3"), F.lit(0.5))
    base = base.withColumn("TARGET", (hash_uniform(seed, F.col("row"), F.lit("y")) < 1 / (1 + F.exp(-logit)))
                           .cast("int"))
    dup = base.where(F.pmod(F.col("row"), F.lit(100)) == 0).withColumn("row", F.col("row") + n)
    return base.unionByName(dup)
