"""Detector: fixture pins, every strict threshold hit exactly and one step either side, degenerate inputs."""

import math

import pytest
from pyspark.sql import functions as F

from splitsafe.functions import tiers
from splitsafe.operators import detector as D
from splitsafe.roles import Roles
from splitsafe.sources.tables import view

from .conftest import SF01


def risks(spark, df, roles):
    rep = D.scan(df, roles).orderBy("check").collect()
    return [r["risk"] for r in rep], rep


@pytest.mark.parametrize("name,expected,score,level", [
    ("orders_y", ["LOW", "CLEAN", "MEDIUM", "HIGH", "CLEAN"], 26, "HIGH"),
    ("orders_post", ["LOW", "CRITICAL", "MEDIUM", "HIGH", "CLEAN"], 51, "CRITICAL"),
    ("events_y", ["LOW", "CLEAN", "LOW", "HIGH", "CLEAN"], 21, "MEDIUM"),
    ("events_hi", ["LOW", "HIGH", "LOW", "CLEAN", "CLEAN"], 21, "MEDIUM"),
])
def test_scan_pins(spark, name, expected, score, level):
    df, roles = view(spark, SF01, name)
    got, rep = risks(spark, df, roles)
    assert got == expected
    s = D.score(D.scan(df, roles)).collect()[0]
    assert (s["score"], s["level"]) == (score, level)


def test_check2_flagged_and_message(spark):
    df, roles = view(spark, SF01, "orders_post")
    r = D.check_correlation(df, roles).collect()[0]
    assert r["flagged"][0]["feature"] == "o_totalprice"
    assert r["flagged"][0]["corr"] == pytest.approx(0.8659, abs=1e-12)
    assert r["message"] == "1 critical (>0.8), 0 high (>0.5) correlation features."


def test_group_message_format(spark):
    df, roles = view(spark, SF01, "orders_y")
    r = D.check_groups(df, roles).collect()[0]
    assert r["message"] == "1,498 of 1,500 groups (99.9%) have multiple rows."


def _cat_df(spark, n_values):
    return spark.range(1000).select(
        (F.col("id") % 2).cast("int").alias("y"),
        F.concat(F.lit("v"), (F.col("id") % n_values).cast("string")).alias("c"))


@pytest.mark.parametrize("n_values,at_risk", [(99, 1), (100, 0), (101, 0)])
def test_cardinality_boundary(spark, n_values, at_risk):
    r = D.check_categorical(_cat_df(spark, n_values), Roles("y")).collect()[0]
    assert r["n_flagged"] == at_risk


@pytest.mark.parametrize("n_cols,risk", [(0, "CLEAN"), (1, "LOW"), (2, "LOW"), (3, "MEDIUM"), (5, "MEDIUM"),
                                         (6, "HIGH")])
def test_categorical_tiers(spark, n_cols, risk):
    df = spark.range(50).select((F.col("id") % 2).cast("int").alias("y"),
                                *[F.lit("a").alias(f"c{i}") for i in range(n_cols)])
    assert D.check_categorical(df, Roles("y")).collect()[0]["risk"] == risk


def test_tier_functions_at_thresholds(spark):
    rows = [(0.3, 0.5, 0.8)]
    df = spark.createDataFrame([(x,) for x in [0.3, 0.3000001, 0.5, 0.5000001, 0.8, 0.8000001]], "a double")
    got = [r[0] for r in df.select(tiers.correlation_tier("a")).collect()]
    assert got == ["normal", "high", "high", "suspicious", "suspicious", "suspicious"]
    g = spark.createDataFrame([(1, 0.0499), (1, 0.05), (1, 0.1999), (1, 0.20), (0, 0.0)], "m long, s double")
    assert [r[0] for r in g.select(tiers.group_risk("m", "s")).collect()] == ["LOW", "MEDIUM", "MEDIUM", "HIGH",
                                                                              "CLEAN"]
    d = spark.createDataFrame([(1, 0.99), (1, 1.0), (1, 4.99), (1, 5.0), (0, 0.0)], "m long, p double")
    assert [r[0] for r in d.select(tiers.duplicate_risk("m", "p")).collect()] == ["LOW", "MEDIUM", "MEDIUM",
                                                                                  "HIGH", "CLEAN"]
    sc = spark.createDataFrame([(x,) for x in [0, 10, 11, 25, 26, 45, 46]], "s int")
    assert [r[0] for r in sc.select(tiers.score_level("s")).collect()] == [
        "CLEAN", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL"]
    inf = spark.createDataFrame([(x,) for x in [0.03, 0.0300001, 0.08, 0.0800001, 0.15, 0.1500001]], "i double")
    assert [r[0] for r in inf.select(tiers.inflation_severity("i")).collect()] == [
        "LOW", "MODERATE", "MODERATE", "HIGH", "HIGH", "CRITICAL"]
    assert rows


def test_time_keywords_match_inside_words():
    assert tiers.time_named(["UPDATED", "OVERTIME", "amount", "y"], exclude=("y",)) == ["UPDATED", "OVERTIME"]


def test_corr_thresholds(spark):
    # x = y exactly → |corr| = 1 → CRITICAL; constant → NULL → dropped → CLEAN
    df = spark.range(100).select((F.col("id") % 2).cast("int").alias("y"))
    crit = df.withColumn("x", F.col("y") * 2.0)
    assert D.check_correlation(crit, Roles("y")).collect()[0]["risk"] == "CRITICAL"
    const = df.withColumn("x", F.lit(3.0))
    assert D.check_correlation(const, Roles("y")).collect()[0]["risk"] == "CLEAN"
    none = df.withColumn("s", F.lit("a"))
    r = D.check_correlation(none, Roles("y")).collect()[0]
    assert (r["risk"], r["message"]) == ("CLEAN", "No numeric features.")


def test_degenerate_inputs(spark):
    empty = spark.createDataFrame([], "y int, x double, g long, s string")
    rep = D.scan(empty, Roles("y", id="g")).orderBy("check").collect()
    assert [r["risk"] for r in rep] == ["LOW", "CLEAN", "LOW", "CLEAN", "CLEAN"]
    one = spark.createDataFrame([(1, 2.0, 7, "a")], "y int, x double, g long, s string")
    assert len(D.scan(one, Roles("y", id="g")).collect()) == 5
    allnull_group = spark.createDataFrame([(1, None), (0, None)], "y int, g long")
    r = D.check_groups(allnull_group, Roles("y", group="g")).collect()[0]
    assert r["risk"] == "CLEAN" and r["n_groups"] == 0
    nog = D.check_groups(one, Roles("y")).collect()[0]
    assert nog["risk"] == "UNKNOWN"
    with pytest.raises(ValueError):
        D.scan(one, Roles("nope"))


def test_duplicates_null_nan_and_negative_zero(spark):
    rows = [(1, None, 0.0), (1, None, -0.0), (2, float("nan"), 1.0), (2, float("nan"), 1.0), (3, 1.0, None),
            (3, None, 1.0)]
    df = spark.createDataFrame(rows, "a int, b double, c double")
    from splitsafe.operators.duplicates import duplicate_count
    for wide in (12, 0):
        r = duplicate_count(df, wide_columns=wide).collect()[0]
        assert r["exact_dupes"] == 2, wide          # (1,null,±0) and (2,NaN,1); (3,1,null) ≠ (3,null,1)


def test_percent_formatting_half_even(spark):
    # 1 multi-group of 8 → 12.5 % → pandas prints 12.5; 1 of 16 → 6.25 → "6.2" (half-even)
    df = spark.createDataFrame([(0, 1), (0, 1)] + [(0, i) for i in range(2, 17)], "y int, g long")
    r = D.check_groups(df, Roles("y", group="g")).collect()[0]
    assert r["message"] == "1 of 16 groups (6.2%) have multiple rows."
    assert math.isclose(1 / 16 * 100, 6.25)


def test_missing_tiers_after_half_even_rounding(spark):
    from splitsafe.functions.numeric import round_half_even
    vals = [10.0, 10.05, 10.06, 40.04, 40.05, 40.06]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r[0] for r in df.select(tiers.missing_tier(round_half_even("p", 1))).collect()]
    # 10.05 → 10.0 (mild), 10.06 → 10.1 (moderate), 40.05 → 40.0 (moderate), 40.06 → 40.1 (severe)
    assert got == ["mild", "mild", "moderate", "moderate", "moderate", "severe"]


def test_all_null_and_missing_categoricals(spark):
    df = spark.createDataFrame([(0, None), (1, None)], "y int, s string")
    r = D.check_categorical(df, Roles("y")).collect()[0]
    assert r["n_flagged"] == 1            # nunique 0 < 100, as a pandas frame would count it
    none = spark.createDataFrame([(0, 1.0), (1, 2.0)], "y int, x double")
    assert D.check_categorical(none, Roles("y")).collect()[0]["risk"] == "CLEAN"


def test_scan_with_score_single_execution(spark):
    df, roles = view(spark, SF01, "orders_y")
    rep, summ = D.scan_with_score(df, roles)
    s = summ.collect()[0]
    assert rep.count() == 5 and (s["score"], s["level"]) == (26, "HIGH")
    assert s["advice"] == tiers.LEVEL_ADVICE["HIGH"]
