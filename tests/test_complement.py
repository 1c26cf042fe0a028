"""Fits of all folds' complements against a fit of each complement by itself."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from splitsafe.operators import complement, fit


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 4000
    fold = rng.integers(0, 5, n)
    a = rng.normal(size=n) * 10.0 ** rng.integers(-200, 200, n)          # heavy tails
    b = np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 50, n))       # one value holds two fifths
    c = rng.normal(size=n) + 1000.0 * fold                               # folds far apart
    rows = [(int(f) if i % 97 else None, float(x), None if i % 5 == 0 else float(y), float("nan") if i % 7 == 0 else float(z),
             float(z) if f == 2 else None, None) for i, (f, x, y, z) in enumerate(zip(fold, a, b, c))]
    return spark.createDataFrame(rows, "fold int, a double, b double, c double, `d e` double, none double").repartition(6).cache()


FEATURES = ["a", "b", "c", "d e", "none"]


def test_equal_to_separate_fits(table, monkeypatch):
    monkeypatch.setattr(complement, "CUTS", 4)
    got = {(r["fold"], r["feature"]): r for r in complement.fold_fit_stats(table, FEATURES, "fold", whole=True).collect()}
    assert len(got) == 6 * len(FEATURES)
    pd = table.toPandas()
    for (fold, feature), r in got.items():
        x = pd[feature][(pd.fold != fold) | pd.fold.isna()] if fold is not None else pd[feature]
        assert (r["n"], r["n_null"]) == (len(x), int(x.isna().sum()))
        if x.notna().any():
            m = x.median()
            assert r["median"] == m
            full = x.fillna(m)
            assert r["mean"] == pytest.approx(full.mean(), rel=1e-9)
            if feature != "a":
                assert r["std_pop"] == pytest.approx(full.std(ddof=0), rel=1e-9)
        else:
            assert r["median"] is r["mean"] is r["std_pop"] is None


def test_same_as_fit_stats(table):
    got = {r["feature"]: r for r in complement.fold_fit_stats(table, ["b", "c"], "fold").where("fold = 3").collect()}
    for r in fit.fit_stats(table, ["b", "c"], F.col("fold").isNull() | (F.col("fold") != 3)).collect():
        assert all(math.isclose(r[k], got[r["feature"]][k], rel_tol=1e-12) for k in ("n", "n_null", "median", "mean", "std_pop"))


def test_odd_tables(spark, table):
    assert complement.fold_fit_stats(table.where("false"), ["a"], "fold").count() == 0
    one = complement.fold_fit_stats(table.where("fold = 1"), ["c"], "fold").collect()
    assert [(r["fold"], r["n"], r["median"]) for r in one] == [(1, 0, None)]
    inf = spark.createDataFrame([(i % 2, x) for i, x in enumerate([float("inf"), float("-inf"), 1.0, 2.0, float("inf"), float("inf")])], "fold int, x double")
    assert {r["fold"]: r["median"] for r in complement.fold_fit_stats(inf, ["x"], "fold").collect()} == {0: 2.0, 1: float("inf")}
