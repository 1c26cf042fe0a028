"""Duplicates of wide tables: Bloom filter of repeated row keys against pandas, and what is exchanged."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from splitsafe.operators import duplicates

COLS = [f"c{i}" for i in range(16)]


@pytest.fixture(scope="module")
def wide(spark):
    """NULLs, NaN and signed zeros in places that must (not) match, a row a third of the table holds, extra names."""
    rng = np.random.default_rng(8)
    rows = [tuple(rng.choice([None, 0.0, -0.0, 1.0, float("nan")], p=[.1, .3, .2, .3, .1], size=3)) + tuple(float(x) for x in rng.integers(0, 3, 13) * (rng.random(13) < .1)) for _ in range(900)]
    rows += [(1.0,) * 16] * 600 + [(None,) + (2.0,) * 15, (2.0,) * 15 + (None,), (2.0, None) + (2.0,) * 14] * 2
    rows += [tuple(float(i * 16 + j) for j in range(16)) for i in range(400)]
    rows = [tuple(None if x is None else float(x) for x in r) + (i,) for i, r in enumerate(rows)]
    order = rng.permutation(len(rows))
    schema = ", ".join(f"{c} double" for c in COLS) + ", k long"
    return rows, spark.createDataFrame([rows[i] for i in order], schema).repartition(6)


def keys_of(rows):
    return [tuple("nan" if x is not None and x != x else None if x is None else x + 0.0 for x in r[:16]) for r in rows]


def test_count_and_keep_first(wide):
    rows, df = wide
    first = {}
    for key, r in zip(keys_of(rows), rows):
        first.setdefault(key, r[16])
    got = duplicates.duplicate_count(df, COLS).first()
    assert (got["n_rows"], got["exact_dupes"]) == (len(rows), len(rows) - len(first))
    kept = duplicates.drop_duplicates(df, COLS, row_key="k").collect()
    assert sorted(r["k"] for r in kept) == sorted(first.values())
    assert duplicates.drop_duplicates(df.select(*COLS)).count() == len(first)


def test_full_filter_changes_nothing(wide, monkeypatch):
    rows, df = wide
    monkeypatch.setattr(duplicates, "MAX_FILTER_BITS", 64)
    monkeypatch.setattr(duplicates, "FILTER_BITS_PER_KEY", 0)
    monkeypatch.setattr(duplicates, "_SEGMENT", 64)
    assert duplicates.duplicate_count(df, COLS).first()["exact_dupes"] == len(rows) - len(set(keys_of(rows)))


def test_no_repeats_and_empty(spark):
    df = spark.range(50).select(*[(F.col("id") + i).alias(c) for i, c in enumerate(COLS)])
    assert tuple(duplicates.duplicate_count(df).first()) == (50, 0) and duplicates.drop_duplicates(df).count() == 50
    assert tuple(duplicates.duplicate_count(df.where("false")).first()) == (0, 0)


def test_only_repeated_rows_are_exchanged(spark, wide):
    rows, df = wide
    keys, n = duplicates._repeated_keys(df, COLS)
    flagged = duplicates._maybe_repeated(df, COLS, keys, n)
    repeats = pd.Series(keys_of(rows)).duplicated(keep=False).to_numpy()
    maybe = {r["k"]: r["__maybe"] for r in flagged.collect()}
    assert all(maybe[i] for i in np.flatnonzero(repeats)) and sum(maybe[i] for i in np.flatnonzero(~repeats)) < 0.1 * (~repeats).sum()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = flagged.where("__maybe").groupBy("__h1", "__h2", *COLS).count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plan = plan.split("== Initial Plan ==")[-1]
    lines = plan.splitlines()
    at = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x and "__h1" in x]
    assert len(at) == 1 and any("__b1" in x or "Filter" in x for x in lines[at[0]:]) and "SortMergeJoin" not in plan
