"""Selection, splits and AUC against brute force, plus split properties."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from splitsafe.operators import metrics, rank, split
from splitsafe.sources.tables import view

from .conftest import SF01


@pytest.fixture(scope="module")
def values(spark):
    # skewed data: a third of the rows share one value, plus ties and NULLs
    rng = np.random.default_rng(3)
    v = np.concatenate([np.full(700, 5.0), rng.normal(0, 100, 1300).round(1), [np.nan] * 20])
    g = np.arange(len(v)) % 3
    pdf = [(int(a), None if np.isnan(b) else float(b)) for a, b in zip(g, v)]
    return spark.createDataFrame(pdf, "g int, x double"), g, v


@pytest.mark.parametrize("max_exact,n_buckets", [(1_000_000, 4096), (40, 4), (5, 2)])
def test_select_kth_matches_sort(spark, values, max_exact, n_buckets):
    df, g, v = values
    targets = [{"g": k, "k": q} for k in range(3) for q in (0, 1, 57, 300, 599, 10_000)]
    got = {(r["g"], r["k"]): (r["value"], r["n_less"])
           for r in rank.select_kth(df, "x", targets, ["g"], max_exact=max_exact, n_buckets=n_buckets).collect()}
    for k in range(3):
        s = np.sort(v[(g == k) & ~np.isnan(v)])
        for q in (0, 1, 57, 300, 599, 10_000):
            if q < len(s):
                assert got[(k, q)] == (s[q], int((s < s[q]).sum()))
            else:
                assert got[(k, q)] == (None, None)


def test_medians_match_pandas(spark, values):
    df, g, v = values
    got = {r["g"]: r["median"] for r in rank.medians(df, ["x"], ["g"], max_exact=30, n_buckets=8).collect()}
    for k in range(3):
        assert got[k] == pytest.approx(float(np.nanmedian(v[g == k])), abs=0)


def test_stratified_split_exact_and_stable(spark):
    df, r = view(spark, SF01, "orders_y")
    a = split.stratified_split(df, "target", "o_orderkey")
    b = split.stratified_split(df.repartition(7), "target", "o_orderkey", max_exact=100, n_buckets=8)
    ta = {x[0] for x in a.where("split='test'").select("o_orderkey").collect()}
    tb = {x[0] for x in b.where("split='test'").select("o_orderkey").collect()}
    assert ta == tb and len(ta) == 3000
    counts = dict(a.groupBy("split").count().collect())
    assert counts == {"train": 12000, "test": 3000}


def test_allocation_largest_remainder():
    assert split.allocate_stratified({0: 10067, 1: 4933}, 0.2) == {0: 2013, 1: 987}
    assert sum(split.allocate_stratified({"a": 7, "b": 3}, 0.25).values()) == 3


def test_group_kfold_never_shares_a_group(spark):
    df, _ = view(spark, SF01, "orders_y")
    for balanced in (False, True):
        f = split.group_kfold(df, "o_custkey", 5, balanced=balanced)
        assert f.groupBy("o_custkey").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
        assert f.where(F.col("fold").isNull()).count() == 0


def test_temporal_split_order(spark):
    df, _ = view(spark, SF01, "orders_y")
    t = split.temporal_split(df, ["o_orderdate", "o_orderkey"], 0.8, max_exact=100, n_buckets=4)
    tr = t.where("split='train'").agg(F.max("o_orderdate")).collect()[0][0]
    te = t.where("split='test'").agg(F.min("o_orderdate")).collect()[0][0]
    assert tr <= te and t.where("split='train'").count() == 12000


def test_sample_exact_size(spark):
    df, _ = view(spark, SF01, "orders_y")
    assert split.sample_rows(df, "o_orderkey", frac=0.3, max_exact=50, n_buckets=4).count() == 4500


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_by_hand(spark):
    df = spark.createDataFrame([(0.9, 1), (0.7, 1), (0.8, 0), (0.4, 0), (0.3, 0)], "s double, y int")
    assert metrics.roc_auc(df, "s", "y").collect()[0]["auc"] == pytest.approx(5 / 6, abs=1e-15)


def test_auc_ties_symmetry_and_one_class(spark):
    rng = np.random.default_rng(1)
    s = rng.integers(0, 20, 400).astype(float)
    y = (rng.random(400) < 0.3).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    auc = metrics.roc_auc(df, "s", "y", bucket_scores=5).collect()[0]["auc"]
    assert auc == pytest.approx(brute_auc(s, y), abs=1e-12)
    neg = metrics.roc_auc(df.withColumn("s", -F.col("s")), "s", "y").collect()[0]["auc"]
    assert neg == pytest.approx(1 - auc, abs=1e-12)
    one = metrics.roc_auc(df.withColumn("y", F.lit(1)), "s", "y").collect()[0]["auc"]
    assert one is None


def test_roc_points_monotone(spark):
    df, _ = view(spark, SF01, "orders_post")
    pts = metrics.roc_points(df, "o_totalprice", "target", 10).orderBy("fpr").collect()
    tprs = [p["tpr"] for p in pts]
    assert len(pts) == 11 and tprs == sorted(tprs) and tprs[-1] == 1.0


def test_auc_of_skewed_groups_in_many_buckets(spark):
    """Cut points of each group's own scores; a score that a third of all rows have; a NULL group; nothing written."""
    rng = np.random.default_rng(4)
    rows = [("wide", float(s)) for s in rng.normal(0, 1e6, 800)] + [("tiny", float(s)) for s in rng.random(500)]
    rows += [("hot", 0.5)] * 900 + [("hot", float(s)) for s in rng.random(300)] + [(None, float(i % 7)) for i in range(90)]
    rows = [(g, s, int(rng.random() < 0.4)) for g, s in rows]
    df = spark.createDataFrame(rows, "g string, s double, y int").repartition(5)
    got = {r["g"]: r["auc"] for r in metrics.roc_auc(df, "s", "y", by=["g"], bucket_scores=20).collect()}
    for g in ("wide", "tiny", "hot", None):
        own = [(s, y) for h, s, y in rows if h == g]
        assert got[g] == pytest.approx(brute_auc(np.array([s for s, _ in own]), np.array([y for _, y in own])), abs=1e-12)
    whole = metrics.roc_auc(df, "s", "y", bucket_scores=50)
    assert whole.collect()[0]["auc"] == pytest.approx(
        brute_auc(np.array([s for _, s, _ in rows]), np.array([y for *_, y in rows])), abs=1e-12)
    buckets = metrics._bucketed(metrics._score_counts(df, "s", "y", []), [], 50).groupBy("bucket").count().collect()
    assert len(buckets) > 10 and max(r["count"] for r in buckets) < 150
    import inspect
    assert "cut_lineage" not in inspect.getsource(metrics) and "checkpoint" not in inspect.getsource(metrics).split('"""')[2]
