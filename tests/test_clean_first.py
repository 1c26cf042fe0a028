"""Cleaning at the head of the model experiments 2-5, and the type lattice."""

import pytest
from pyspark.sql import functions as F

from splitsafe.operators import clean, experiments
from splitsafe.roles import Roles
from splitsafe.sources import csv

R = Roles(target="TARGET", id="SK_ID_CURR", group="SK_ID_CURR", time="app_date", row_key="row")
FEATURES = ["EXT_SOURCE_2", "EXT_SOURCE_3", "DAYS_BIRTH", "DAYS_EMPLOYED", "MOSTLY_NULL"]


@pytest.mark.parametrize("run", [
    lambda d, f, c: experiments.experiment_2(d, R, f, clean_first=c),
    lambda d, f, c: experiments.experiment_3(d, R, f, ["app_date", "row"], clean_first=c),
    lambda d, f, c: experiments.experiment_5(d, R, f, clean_first=c)])
def test_experiments_clean_their_table(loan, run):
    by_hand = clean.fix_quirks(loan.drop("MOSTLY_NULL"))[0]
    want = run(by_hand, [f for f in FEATURES if f != "MOSTLY_NULL"], False).first()
    got = run(loan, FEATURES, True).first()
    assert got["honest_auc"] == pytest.approx(want["honest_auc"], abs=1e-9)
    assert got["leaky_auc"] == pytest.approx(want["leaky_auc"], abs=1e-9)


def test_cleaned_keeps_keys_and_drops_repeats(loan):
    df, features = experiments._cleaned(loan.unionAll(loan), FEATURES, ["row", "app_date", "TARGET"])
    assert df.count() == loan.count() and "app_date" in df.columns and "MOSTLY_NULL" not in features


@pytest.mark.parametrize("cells,kind", [
    (["1", "2", None], "bigint"), (["1", " 2.5 "], "double"), (["1", "99999999999999999999"], "double"), (["True", "false"], "boolean"),
    (["True", "1"], "string"), (["1", "x"], "string"), (["NA", ""], "double"), (["12D"], "string"), (["inf", "1"], "double"), ([], "double")])
def test_narrowest_common_type(spark, cells, kind):
    df = spark.createDataFrame([(c,) for c in cells], "`a.b` string").withColumnRenamed("a.b", "v")
    assert csv.infer_types(df).dtypes == [("v", kind)]


def test_drop_null_rows(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (float("nan"), "c"), (2.0, None)], "x double, s string")
    assert [r["s"] for r in clean.drop_null_rows(df, ["x", "absent"]).collect()] == ["a", None]
    assert clean.drop_null_rows(df, ["x", "s"]).count() == 1
