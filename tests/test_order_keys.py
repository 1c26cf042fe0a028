"""Thresholds on text and long decimals (F4), row keys of repeated ids (B9) and odd keys."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from splitsafe.operators import experiments, rank, split
from splitsafe.roles import Roles


def texts(seed):
    rng = random.Random(seed)
    stem = "https://example.org/" + "x" * rng.randrange(60)
    parts = ["", "a", "b", "ab", "é", "日本", "\U0001f600", "\x00", "\x01", "z" * 9]
    out = [stem + "".join(rng.choices(parts, k=rng.randrange(5))) for _ in range(300)]
    return out + [stem + "same" * 40] * 200 + [""] * 3


@pytest.mark.parametrize("seed", range(4))
def test_rank_of_texts(spark, seed):
    rows = [(g, t) for g in ("u", "v") for t in texts(seed + (g == "v") * 9)] + [("u", None), ("w", None)]
    df = spark.createDataFrame(rows, "g string, t string")
    for k in (0, 100, 260, 400, 502):
        got = {r["g"]: (r["value"], r["n_less"], r["n_eq"]) for r in rank._select_text(
            df, "t", [{"g": g, "k": k} for g in ("u", "v", "w")], ["g"], max_exact=5, n_buckets=4)}
        for g in ("u", "v"):
            own = sorted((t for h, t in rows if h == g and t is not None), key=lambda t: t.encode())
            assert got[g] == (own[k], sum(t.encode() < own[k].encode() for t in own), own.count(own[k]))
        assert got["w"] == (None, None, None)


@pytest.mark.parametrize("precision,scale", [(38, 10), (38, 0), (38, 38), (20, 2), (9, 3)])
def test_temporal_split_by_decimal(spark, precision, scale):
    rng = random.Random(precision + scale)
    top = 10 ** precision - 1
    units = {rng.choice([-1, 1]) * rng.choice([rng.randrange(top), rng.randrange(1000), top - rng.randrange(50), 10 ** (precision - 1) + rng.randrange(9)]) for _ in range(200)} | {0, top, -top}
    values = [Decimal(u).scaleb(-scale, context=__import__("decimal").Context(prec=60)) for u in units]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType([T.StructField("i", T.LongType()), T.StructField("d", T.DecimalType(precision, scale))]))
    train = {r["i"] for r in split.temporal_split(df, ["d"], 0.8, max_exact=20, n_buckets=8).where("split = 'train'").collect()}
    order = sorted(range(len(values)), key=lambda i: values[i])
    assert train == set(order[:int(len(values) * 0.8)])


def test_split_by_text_then_number_with_ties_and_nulls(spark):
    rows = [("2024-01-%02d" % (i % 9 + 1) if i % 11 else None, i if i % 13 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "t string, k long")
    got = {(r["t"], r["k"]): r["split"] for r in split.temporal_split(df, ["t", "k"], 0.7, max_exact=9, n_buckets=4).collect()}
    known = sorted((t, k) for t, k in rows if t is not None and k is not None)
    want = {r: "train" if i < int(len(known) * 0.7) else "test" for i, r in enumerate(known)}
    assert {r: s for r, s in got.items() if None not in r} == want and all(s is None for r, s in got.items() if None in r)


def test_row_key_of_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(split, "COPIES_AT_ONCE", 7)
    rows = [(1, "hot", 2.0)] * 50 + [(1, "x", float(i)) for i in range(20)] + [(2, None, None)] * 3 + [(None, "n", 1.0), (7, "y", 0.0)]
    df = spark.createDataFrame(rows, "id long, s string, x double")
    a, b = (split.with_row_key(d, "id").collect() for d in (df.repartition(3), df.orderBy("x").repartition(5)))
    assert Counter(tuple(r) for r in a) == Counter(tuple(r) for r in b)
    assert Counter(tuple(r)[:3] for r in a) == Counter(rows) and len({r["row_key"] for r in a}) == len(rows)
    once = split.with_row_key(df.where("id = 7"), "id").collect()
    assert [r["row_key"] for r in once] == [7]
    assert split.with_row_key(df.select("s").distinct()).count() == len({s for _, s, _ in rows})


@pytest.mark.parametrize("key", ["cast(id as string)", "id + 5000000000000000000", "cast(id as decimal(30,3))", "cast(id as int)"])
def test_experiment_5_with_odd_keys(spark, key):
    df = spark.range(600).select(F.expr(key).alias("k"), (F.col("id") % 40).alias("a"), (F.col("id") % 7).alias("b"),
                                 ((F.col("id") * 7) % 3 == 0).cast("int").alias("y"))
    r = experiments.leak5_duplicates(df, Roles(target="y", id="k", row_key="k"), ["a", "b"]).first()
    assert 0 <= r["honest_auc"] <= 1 and 0 <= r["leaky_auc"] <= 1
    keys = df.withColumn("copy_no", F.lit(0)).unionByName(df.withColumn("copy_no", F.lit(1)))
    assert keys.select(experiments.copy_key(keys, "k").alias("c")).distinct().count() == 1200
