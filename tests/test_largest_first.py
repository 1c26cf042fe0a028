"""Largest-first folds against dealing the groups one by one."""

import random
from collections import Counter, defaultdict

import pytest

from splitsafe.operators import split


def one_by_one(sizes, k):
    loads = [0] * k
    for n in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += n
    return loads


@pytest.mark.parametrize("seed", range(40))
def test_deal_is_the_greedy_one(seed):
    rng = random.Random(seed)
    k = rng.choice([1, 2, 3, 5, 8])
    sizes = [rng.choice([1, 1, 1, 2, 3, 7, int(rng.paretovariate(0.6)) % 900 + 1]) for _ in range(rng.choice([1, 4, 60, 2000]))]
    deal = split.deal_largest_first(dict(Counter(sizes)), k)
    assert {s: sum(m) for s, m in deal.items()} == dict(Counter(sizes))
    assert [sum(s * m[f] for s, m in deal.items()) for f in range(k)] == one_by_one(sizes, k)


def test_folds_of_a_skewed_table(spark):
    rng = random.Random(3)
    rows = [("hot",)] * 500 + [(f"g{i}",) for i in range(300) for _ in range(rng.choice([1, 1, 2, 5]))] + [(None,)] * 9
    df = spark.createDataFrame(rows, "g string")
    got = split.group_kfold(df, "g", 4, balanced="largest_first", n_buckets=7).collect()
    folds = defaultdict(set)
    for r in got:
        folds[r["g"]].add(r["fold"])
    assert folds.pop(None) == {None} and all(len(f) == 1 for f in folds.values())
    loads = Counter(r["fold"] for r in got if r["g"] is not None)
    assert [loads[f] for f in range(4)] == one_by_one(Counter(g for g, in rows if g).values(), 4)
    assert split.group_kfold(df.where("false"), "g", 4, balanced="largest_first").count() == 0
