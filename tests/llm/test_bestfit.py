"""Best-fit decreasing packing against the library's ids and a piece-by-piece loop."""

import bisect
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from splitsafe.llm import bestfit, common, tokens

from .test_operators import DOCS, ODD, SF


def one_by_one(sizes, length):
    """Rooms of the sequences that best-fit decreasing leaves, piece by piece."""
    rooms = []
    for n in sorted(sizes, reverse=True):
        i = bisect.bisect_left(rooms, n)
        room = rooms.pop(i) if i < len(rooms) else length
        bisect.insort(rooms, room - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    length = rng.choice([7, 16, 64, 2048])
    sizes = [min(length, int(rng.paretovariate(0.7))) if seed % 2 else rng.randrange(1, length + 1) for _ in range(rng.choice([1, 30, 3000]))]
    rows, used = bestfit.plan(dict(Counter(sizes)), length)
    room = defaultdict(lambda: length)
    steps = defaultdict(list)
    for r in rows.tolist():
        steps[r[0]].append(r)
    places = defaultdict(list)
    for size, n in Counter(sizes).items():
        for rank in range(n):
            step = [s for s in steps[size] if s[1] <= rank][-1]
            seq = step[2] + (rank - step[1]) // step[3]
            places[seq].append((step[4] + (rank - step[1]) % step[3] * size, size))
            room[seq] -= size
    assert sorted(room.values()) == one_by_one(sizes, length) and len(room) == used
    for held in places.values():
        assert [o for o, _ in sorted(held)] == np.cumsum([0] + [n for _, n in sorted(held)])[:-1].tolist()


def test_least_room():
    tree = bestfit.RoomTree(10)
    assert tree.least(1) is None
    for r in (3, 7, 10):
        tree.set(r, True)
    assert [tree.least(n) for n in range(1, 11)] == [3, 3, 3, 7, 7, 7, 7, 10, 10, 10]
    tree.set(10, False)
    assert tree.least(8) is None and tree.least(0) == 3


@pytest.mark.parametrize("length", [64, 2048])
def test_pack_whole_tables(spark, length):
    extra = spark.createDataFrame(ODD, DOCS).selectExpr("*", "1 as piece", "2 as part", "3 as k", "4 as rank")
    for df in (common.table(spark, SF, "documents").repartition(5), extra, spark.createDataFrame([], DOCS)):
        enc = tokens.encoder(tokens.word_tokenizer())
        want = Counter()
        sizes = []
        for r in df.collect():
            ids = enc.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]
            for i in range(0, len(ids), length):
                own = ids[i:i + length]
                want[r["doc_id"], i // length, i, np.array(own, "<u4").tobytes()] += 1
                sizes.append(len(own))
        rows = bestfit.pack(df, tokens.word_tokenizer(), length=length).collect()
        assert Counter((r["doc_id"], r["piece"], r["start"], bytes(r["ids"])) for r in rows) == want
        held = defaultdict(list)
        for r in rows:
            assert len(r["ids"]) == 4 * r["length"]
            held[r["sequence_id"]].append((r["offset"], r["length"]))
        for places in held.values():
            assert [o for o, _ in sorted(places)] == np.cumsum([0] + [n for _, n in sorted(places)])[:-1].tolist()
        assert sorted(length - sum(n for _, n in p) for p in held.values()) == one_by_one(sizes, length)
