"""The pinned values of FIXTURES.md §4 at sf0.01."""

import pytest
from pyspark.sql import functions as F

from splitsafe.operators import duplicates, encode, experiments as X, metrics, profile, split
from splitsafe.sources.tables import table, view

from .conftest import SF01


def test_cardinality_and_correlation_pins(spark):
    ev, r = view(spark, SF01, "events_y")
    d = {x["column"]: x["n_distinct"] for x in profile.distinct_counts(ev, ["props"]).collect()}
    assert d["props"] == 100
    assert ev.agg(F.approx_count_distinct("props")).collect()[0][0] == 99   # why the exact recount exists
    op, ro = view(spark, SF01, "orders_post")
    c = {x["feature"]: x["corr"] for x in profile.target_correlations(op, ro).collect()}
    assert c["o_totalprice"] == pytest.approx(0.865932, abs=5e-7)
    eh, rh = view(spark, SF01, "events_hi")
    c = {x["feature"]: x["corr"] for x in profile.target_correlations(eh, rh).collect()}
    assert c["value"] == pytest.approx(0.699545, abs=5e-7)


def test_group_and_duplicate_pins(spark):
    g = profile.group_sizes(table(spark, SF01, "orders"), "o_custkey").collect()[0]
    assert (g["n_multi_groups"], g["n_groups"]) == (1498, 1500)
    g = profile.group_sizes(table(spark, SF01, "lineitem"), "l_orderkey").collect()[0]
    assert (g["n_multi_groups"], g["n_groups"]) == (13623, 14743)
    d = duplicates.duplicate_count(table(spark, SF01, "documents"), ["text"]).collect()[0]
    assert (d["exact_dupes"], d["n_rows"]) == (73, 1000)
    ln, _ = view(spark, SF01, "line_narrow")
    d = duplicates.duplicate_count(ln).collect()[0]
    assert (d["exact_dupes"], d["n_rows"]) == (35223, 60000)


def test_missing_pin(spark):
    dl, _ = view(spark, SF01, "doc_labels")
    m = {x["column"]: round(x["pct_missing"], 1) for x in profile.null_profile(dl).collect()}
    assert m["quality"] == 60.1 and m["toxic"] == 60.1


def test_split_pins(spark):
    oy, r = view(spark, SF01, "orders_y")
    h = split.hash_split(oy, "o_orderkey", 0.2, 42).where("split = 'test'")
    assert (h.count(), h.where("target = 1").count()) == (3037, 1015)
    ov = split.group_overlap(split.hash_split(oy, "o_orderkey", 0.2, 42), "o_custkey").collect()[0]
    assert (ov["n_both"], ov["n_train_groups"], ov["n_test_groups"]) == (1290, 1499, 1291)
    folds = dict(split.group_kfold(oy, "o_custkey", 5, 42).groupBy("fold").count().collect())
    assert [folds[i] for i in range(5)] == [2849, 3375, 3060, 2764, 2952]


def test_leak1_pin_on_hash_split(spark):
    oy, r = view(spark, SF01, "orders_y")
    res = X.leak1_target_encoding(oy, r, "o_custkey", mode="hash").collect()[0]
    assert res["leaky_auc"] == pytest.approx(0.681219, abs=5e-7)
    assert res["honest_auc"] == pytest.approx(0.495505, abs=5e-7)
    assert res["inflation"] == pytest.approx(0.185714, abs=1e-6)
    s = split.hash_split(oy, "o_orderkey", 0.2, 42)
    enc = encode.target_encode(s, "o_custkey", "target", None, fallback=None, name="score")
    assert metrics.roc_auc(enc.where("split = 'test'"), "score", "target").collect()[0]["auc"] == \
        pytest.approx(0.681219, abs=5e-7)
