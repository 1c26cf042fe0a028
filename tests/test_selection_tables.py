"""Selection whose state is a table (K1) against sorted lists, on skewed groups and odd values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from splitsafe.operators import rank


@pytest.fixture
def skewed(spark):
    """A group with a third of all rows, one with a heavy tail and infinities, one of a single value, many small ones."""
    rng = np.random.default_rng(5)
    parts = [("hot", rng.normal(size=6000)), ("tail", np.concatenate([10.0 ** rng.uniform(-300, 300, 3000), [np.inf, -np.inf] * 20])),
             ("one", np.full(2500, 3.25)), ("two", np.repeat([1.0, 2.0], 900)), (None, rng.integers(0, 9, 700).astype(float))]
    parts += [(f"g{i}", rng.integers(-5, 5, rng.integers(1, 9)).astype(float)) for i in range(900)]
    rows = [(g, float(v)) for g, x in parts for v in x] + [("g1", None), ("void", None), ("g2", float("nan"))]
    return rows, spark.createDataFrame(rows, "g string, x double").repartition(6)


@pytest.mark.parametrize("joined", [False, True])
def test_ranks_of_many_groups(spark, skewed, monkeypatch, joined):
    rows, df = skewed
    monkeypatch.setattr(rank, "DRIVER_STATE", 5)
    if joined:
        monkeypatch.setattr(rank, "BROADCAST_STATE", 0)
    got = {(r["g"], r["k"]): (r["value"], r["n_less"], r["n_eq"])
           for r in rank.select_kth(df, "x", rank.MIDDLE, ["g"], n_buckets=16, max_exact=50).collect()}
    want = {}
    for g, own in pd.DataFrame(rows, columns=["g", "x"]).dropna(subset="x").groupby("g", dropna=False)["x"]:
        x = np.sort(own.to_numpy())
        for k in {(len(x) - 1) // 2, len(x) // 2}:
            want[(None if pd.isna(g) else g, k)] = (x[k], (x < x[k]).sum(), (x == x[k]).sum())
    assert got == want
    asked = spark.createDataFrame([("hot", 5999), ("hot", 6000), ("one", 7), ("nobody", 0), (None, 699)], "g string, k long")
    got = {(r["g"], r["k"]): r["value"] for r in rank.select_kth(df, "x", asked, ["g"], n_buckets=16, max_exact=50).collect()}
    by = lambda n: sorted(v for g, v in rows if g == n and v is not None)
    assert got == {("hot", 5999): by("hot")[-1], ("hot", 6000): None, ("one", 7): 3.25, ("nobody", 0): None, (None, 699): by(None)[-1]}


def test_medians_of_300_000_groups(spark):
    n = 300_000
    df = spark.range(0, 4 * n, 1, 8).select((F.col("id") % n).alias("g"), ((F.col("id") * 7919) % 1009).cast("double").alias("x"))
    res = rank.medians(df, ["x"], ["g"])
    want = pd.DataFrame({"g": np.arange(4 * n) % n, "x": (np.arange(4 * n) * 7919) % 1009}).groupby("g")["x"].median()
    got = res.toPandas().set_index("g")["median"].sort_index()
    assert len(got) == n and (got.to_numpy() == want.to_numpy()).all()


def test_no_group_state_on_the_driver(spark, skewed, monkeypatch):
    _, df = skewed
    monkeypatch.setattr(rank, "DRIVER_STATE", 5)
    plan = rank.medians(df, ["x"], ["g"], max_exact=50)._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and not hasattr(rank, "MAX_GROUPS")
