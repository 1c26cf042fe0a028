"""Self-join of documents on the Jaccard similarity of their word shingles, by grouped prefixes.

A document's set holds its distinct 5-word shingles (A-Z lower-cased). Two sets link when
``100 * |x & y| >= 75 * |x | y|``. Let ``l(n) = max(2, n / 16)``, rounded down. With any total order of
shingles, two linked sets of at least two shingles share at least l(smaller size) of their first
``floor(n / 4) + l(n)`` shingles (the prefix).

1. *Order.* Shingles that repeat inside chunks of the corpus are counted over all documents; the most
   frequent ones (a bounded list) go to the end of the order, by count, the others stand in hash order.
   Any order gives the same result; this one keeps common passages out of the prefixes.
2. *Groups.* Equal sets are one node; nodes with the same prefix and size are one group, and only groups
   are posted under their prefix shingles. Shingles of a single group fall away in the first shuffle.
3. *Stars.* Under each shingle every group is paired with the first one only, so that the pairs grow with
   the postings, not with their square; each group takes the one it meets most often. Groups expand to their members, sets are compared exactly, and
   links give components. Under shingles that then hold several components, a few more rounds of stars follow
   with other centres, so that a large group of copies becomes one component by a few comparisons each.
4. *Rest.* Under shingles whose members still lie in different components all pairs across components
   (of fitting size, with l shingles in common) are compared exactly too; they are found by a second, shorter
   prefix over the shingles still in question. Pairs inside one component need no comparison: the result asks
   for components.

A text without words (or null) has an empty set and links with nothing. Rows with a null id
link with equal sets only, and null is a component's id only if all its rows have null ids; repeated rows are equal sets and stay separate rows; an empty table gives
no rows; extra columns have no effect. Sets are held as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from . import common

SHINGLE, PERCENT = 5, 75
CHUNK_SHINGLES = 2_000_000
STAR_ROUNDS = 2
FREQUENT = 500_000          # at most so many shingles are moved to the end of the order
SALTS = 64
SLICES = 4                  # of the shingles; one slice's postings are shuffled at a time
HOT = 1000
BROADCAST_ROWS = 2_000_000  # of (long, long); above, a shuffled join


def required(n: int) -> int:
    """The least intersection of a set of ``n`` shingles with any set it links with."""
    return -(-PERCENT * n // 100)


def shared(n: int) -> int:
    """How many shingles of their prefixes two linked sets share at least, ``n`` the smaller size."""
    return max(2, n // 16)


SHARED = "greatest(2, {n} div 16)"


def _sets(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, np.ndarray]]:
    for i, raw in enumerate(common.texts_of(batch.column(name))):
        yield i, common.shingle_set(common.words_of(raw)[0], SHINGLE) if raw is not None else np.zeros(0, np.uint64)


def _node(s: np.ndarray) -> int:
    """A set's 64-bit name, from its shingles in order."""
    at = common.mix(np.arange(1, len(s) + 1, dtype=np.uint64))
    return int(common.signed(common.mix(np.array([(s * (at | np.uint64(1))).sum(dtype=np.uint64) + np.uint64(len(s))])))[0])


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (doc_id, n, node) per document; rows (token, count) for shingles that repeat in a chunk."""
    chunk, size = [], 0

    def counted():
        flat = np.concatenate(chunk)
        chunk.clear()
        flat.sort()
        same = np.r_[False, flat[1:] == flat[:-1], False]
        start, end = np.flatnonzero(~same[:-1] & same[1:]), np.flatnonzero(same[:-1] & ~same[1:])
        token, n = flat[start], end - start + 1
        none = pa.nulls(len(token), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, pa.array(common.signed(token)), pa.array(n.astype(np.int64))],
                                          ["doc_id", "n", "node", "token", "count"])

    seen: set[int] = set()
    for batch in batches:
        n, node = [], []
        for _, s in _sets(batch, "text"):
            n.append(len(s))
            node.append(_node(s))
            if node[-1] in seen:  # equal sets count once in a task
                continue
            seen.add(node[-1])
            chunk.append(s)
            size += len(s)
            if size >= CHUNK_SHINGLES:
                yield counted()
                size = 0
        none = pa.nulls(len(n), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), none, none],
                                         ["doc_id", "n", "node", "token", "count"])
    if size:
        yield counted()


def _poster(frequent: np.ndarray):
    """Rows (token, salt, group, n, node): a node's row per prefix shingle of its group."""
    by_hash = np.argsort(frequent)
    sorted_ = frequent[by_hash]

    def prefix(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = min(len(s), len(s) - required(len(s)) + shared(len(s)))
        if not len(sorted_):
            return s[:k], np.zeros(k, bool)
        at = np.minimum(np.searchsorted(sorted_, s), len(sorted_) - 1)
        common_ = sorted_[at] == s
        rare = s[~common_][:k]
        late = frequent[np.sort(by_hash[at[common_]])[:k - len(rare)]] if len(rare) < k else s[:0]
        return np.concatenate([rare, late]), np.r_[np.zeros(len(rare), bool), np.ones(len(late), bool)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[j] for x in out])) for j in range(5)],
                                              ["token", "salt", "grp", "n", "node"])

        seen: set[int] = set()  # equal sets of one task are posted once
        for batch in batches:
            for _, s in _sets(batch, "text"):
                if len(s) < 2 or (node := _node(s)) in seen:
                    continue
                seen.add(node)
                p, late = prefix(s)
                group = _node(np.r_[p, np.uint64(len(s))])
                k = len(p)
                out.append((common.signed(p), np.where(late, 1 + group % SALTS, 0).astype(np.int32), np.full(k, group),
                            np.full(k, len(s), np.int32), np.full(k, node)))
                held += k
                if held > 200_000:
                    yield rows()
                    out, held = [], 0
        if held:
            yield rows()

    return task


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted postings: keeps those of shingles with two nodes or more (or salted ones); adds the run's first group."""
    names = ["token", "salt", "grp", "n", "node"]
    last, first = None, None  # rows not yet given out, and the first group, size and node of their run

    def rows(cols, pivot, keep):
        got = [c[keep] for c in cols] + [p[keep] for p in pivot[:2]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in got], [*names, "pivot", "pivot_n"])

    for batch in batches:
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in names]
        if not len(cols[0]):
            continue
        if last is not None:
            cols = [np.concatenate([a, b]) for a, b in zip(last, cols)]
        again = np.r_[False, np.logical_and.reduce([cols[k][1:] == cols[k][:-1] for k in (0, 1, 2, 4)])]
        cols = [c[~again] for c in cols]
        new = np.r_[True, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])]
        start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        pivot = [cols[k][start] for k in (2, 3, 4)]
        if first is not None:
            mine = start == 0
            pivot = [np.where(mine, f, p) for f, p in zip(first, pivot)]
        spread = np.zeros(len(new), bool)
        spread[start[cols[4] != pivot[2]]] = True  # a node other than the run's first
        keep = spread[start] | (cols[1] > 0)
        # the last run may go on, so its last row waits (a run not kept so far is one row: repeats are gone)
        keep_now = keep.copy()
        keep_now[-1] = False
        last = [c[-1:] for c in cols]
        first = [p[-1:] for p in pivot]
        if keep_now.any():
            yield rows(cols, pivot, keep_now)
        held_keep = keep[-1]
    if last is not None and held_keep:
        yield rows(last, first, np.ones(1, bool))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, x, y = (batch.column(k) for k in ("a", "b", "sa", "sb"))
        keep = []
        for i in range(batch.num_rows):
            s, t = np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64)
            both = len(s) + len(t) - len(np.union1d(s, t))
            keep.append(100 * both >= PERCENT * (len(s) + len(t) - both))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, held, out = batch.column("node").to_pylist(), 0, {}
        for i, s in _sets(batch, "text"):
            if _node(s) == node[i]:  # another text of a repeated id is left out
                out[node[i]] = s.tobytes()
                held += 8 * len(s)
            if held > 4_000_000 or i + 1 == batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.int64()), pa.array(out.values(), pa.binary())], ["node", "s"])
                held, out = 0, {}


class _Join:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        self.spark = docs.sparkSession
        survey = common.written(self.docs.mapInArrow(common.lean(_survey), "doc_id long, n long, node long, token long, count long"), "survey")
        self.base = common.written(survey.where("n is not null").select("doc_id", "n", "node"), "base")
        self.unique = not self.base.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").limit(1).count()
        counts = common.written(survey.where("token is not null").groupBy("token").agg(F.sum("count").alias("count")), "counts")
        common.release(survey)
        # the least count that at most FREQUENT shingles reach; counts from 1024 on are told apart by bit length only
        size = F.when(F.col("count") < 1024, F.col("count")).otherwise(1000 + F.length(F.bin("count")))
        steps = counts.groupBy(size.alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect()
        least, total = 1 << 30, 0
        for r in steps:
            total += r["n"]
            if total > FREQUENT:
                break
            least = r["c"]
        top = counts.where(size >= least).toArrow()  # at most FREQUENT rows
        common.release(counts)
        token, count = (top.column(k).to_numpy() for k in ("token", "count"))
        self.frequent = token.astype(np.int64)[np.lexsort((token, count))].view(np.uint64)

    def postings(self) -> DataFrame:
        n = max(1, common.partitions_for(self.spark) // SLICES)
        rows = common.written(self.docs.mapInArrow(common.lean(_poster(self.frequent)), "token long, salt int, grp long, n int, node long"), "prefixes")
        parts = []
        for k in range(SLICES):
            dealt = rows.where(F.pmod("token", F.lit(SLICES)) == k).repartition(n, "token", "salt").sortWithinPartitions("token", "salt", "grp", "node")
            parts.append(common.written(dealt.mapInArrow(common.lean(_runs), "token long, salt int, grp long, n int, node long, pivot long, pivot_n int"), "postings"))
        common.release(rows)
        return reduce(DataFrame.unionAll, parts)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of nodes that link. Sets are made anew for the nodes in question only."""
        pairs = common.written(pairs.select("a", "b"), "pairs")
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        one = common.written(self.base.join(wanted, "node", "left_semi").groupBy("node")
                             .agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null"), "wanted")
        ids = F.broadcast(one) if one.count() <= BROADCAST_ROWS else one
        docs = self.docs.join(ids, "doc_id")
        sets = docs.select("node", "text").mapInArrow(common.lean(_set_rows), "node long, s binary")
        sets = common.written(sets if self.unique else sets.dropDuplicates(["node"]), "sets")  # a node's rows are those of one id
        left = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
        both = left.join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
        links = common.written(both.select("a", "b", "sa", "sb").mapInArrow(common.lean(_verify), "a long, b long"), "links")
        common.release(pairs, one, sets)
        return links


def _fits(n: str, m: str):
    return F.expr(f"100 * least({n}, {m}) >= {PERCENT} * greatest({n}, {m})")


def _needed(n: str, m: str) -> str:
    """How many prefix shingles sets of sizes n and m must share to link.

    Let x be the one whose prefix ends earlier in the order. Shingles in common up to there lie in both prefixes;
    beyond, there are at most ``n - prefix`` in x. Together they must reach the least intersection.
    """
    rest = lambda k: f"({k} - least({k}, {k} - ({PERCENT} * {k} + 99) div 100 + {SHARED.format(n=k)}))"
    return (f"greatest({SHARED.format(n=f'least({n}, {m})')}, ({PERCENT} * ({n} + {m}) + {99 + PERCENT}) div {100 + PERCENT}"
            f" - greatest({rest(n)}, {rest(m)}))")


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with n and node, links between nodes that make the components of the similarity graph)."""
    job = _Join(docs, id_col, text_col)
    posted = job.postings()

    # stars: of all first groups a group meets, those with most shingles in common first
    stars = (posted.where("grp <> pivot").where(_fits("n", "pivot_n")).groupBy("grp", "pivot").agg(F.count(F.lit(1)).alias("c"), F.min(F.least("n", "pivot_n")).alias("low"))
             .where("c >= " + SHARED.format(n="low")).select("grp", "pivot", "c"))
    # a frequent shingle's list is split by salt: its first groups meet as well
    firsts = posted.where("salt > 0").select("token", "pivot", "pivot_n").distinct()
    least = firsts.groupBy("token").agg(F.min(F.struct("pivot_n", "pivot")).alias("z"))
    across = (firsts.join(least, "token").where("pivot <> z.pivot").where(_fits("pivot_n", "z.pivot_n"))
              .groupBy(F.col("pivot").alias("grp"), F.col("z.pivot").alias("pivot")).agg(F.count(F.lit(1)).alias("c")))
    best = (stars.union(across).groupBy("grp").agg(F.max(F.struct("c", "pivot")).alias("z"))
            .select("grp", F.col("z.pivot").alias("pivot")))
    members = common.written(posted.select("grp", "node").distinct(), "members")
    head = members.groupBy("grp").agg(F.min("node").alias("head"))
    inside = members.join(head, "grp").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    outside = (best.join(members, "grp").join(head.withColumnRenamed("grp", "pivot"), "pivot")
               .select(F.col("node").alias("a"), F.col("head").alias("b")))
    pair = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    first = job.verified(inside.union(outside).where("a <> b").select(*pair).distinct())
    common.release(members)

    # more stars under shingles that still hold more than one component. The first centre is the node that
    # shares the largest part of its shingles (an original among its copies), then some by hash
    share = F.count(F.lit(1)).over(Window.partitionBy("node")) / F.col("n")
    rows = posted.select("token", "node", "n")      # a shingle and its salt lie in one task, where repeats went
    edges, held, n = first, posted, 0
    while True:
        label = common.components(edges)
        own = rows.drop("label").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        own = common.written(own.select("token", "node", "n", (share if not n else F.col("share")).alias("share"), "label"), "labelled")
        common.release(held, label)
        open_ = own.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("token")
        rows = held = common.written(own.join(open_, "token", "left_semi"), "open")
        common.release(own)
        if n == STAR_ROUNDS:
            break
        n += 1
        first_by = F.col("share") if n == 1 else F.xxhash64("node", F.lit(n)).cast("double")
        centre = rows.groupBy("token").agg(F.max(F.struct(first_by.alias("h"), "node", "n", "label")).alias("z"))
        met = (rows.join(centre, "token").where(F.expr("label <> z.label") & _fits("n", "z.n"))
               .groupBy("node", F.col("z.node").alias("centre")).agg(F.count(F.lit(1)).alias("c"), F.min(F.least("n", "z.n")).alias("low"))
               .where("2 * c >= " + SHARED.format(n="low")))
        stars = met.groupBy("node").agg(F.max(F.struct("c", "centre")).alias("z")).select(F.col("node").alias("a"), F.col("z.centre").alias("b"))
        found = job.verified(stars.select(*pair).distinct())
        if not found.limit(1).count():
            common.release(found)
            break
        edges = edges.unionAll(found)

    # the rest: all pairs across components that share enough; a node with too few shingles left can't.
    # With a node's k open shingles in one order (rare ones first), the first one that a pair shares is followed
    # by all the others it shares: it is among the first k - needed + 1 of both, so only those are joined
    count = rows.groupBy("node").agg(F.count(F.lit(1)).alias("k"))
    size = rows.groupBy("token").agg(F.count(F.lit(1)).alias("size"))
    rows = rows.join(count, "node").where(f"k >= {SHARED.format(n='n')}").join(size, "token")
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("node").orderBy("size", "token")))
    rows = common.written(rows.select("token", "node", "n", "label", "k", "pos"), "rest")
    common.release(held)
    early = rows.where(f"pos <= k - {SHARED.format(n='(75 * n div 100)')} + 1")
    l, r = early.alias("l"), early.alias("r")
    needed = _needed("l.n", "r.n")
    met = (l.join(r, F.expr("l.token = r.token and l.node > r.node and l.label <> r.label") & _fits("l.n", "r.n")
                  & F.expr(f"l.pos <= l.k - {needed} + 1 and r.pos <= r.k - {needed} + 1"))
           .select(F.col("l.node").alias("a"), F.col("r.node").alias("b"), F.col("l.n").alias("n"), F.col("r.n").alias("m")).distinct())
    own = rows.groupBy("node").agg(F.collect_list("token").alias("tokens"))
    more = (met.join(own.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
            .join(own.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
            .where("size(array_intersect(x, y)) >= " + _needed("n", "m")).select("a", "b"))
    edges = edges.unionAll(job.verified(more))
    common.release(rows)
    return job.base, edges


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of ``docs``: doc_id, n_shingles, component_id (the smallest id
    reachable by links), component_node (that of the component) and node (that of the set)."""
    base, edges = links(docs, id_col, text_col)
    label = common.components(edges)
    nodes = (base.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("size")).join(label, "node", "left")
             .withColumn("label", F.coalesce("label", "node")))
    least = nodes.groupBy("label").agg(F.min("low").alias("component_id"))
    nodes = common.written(nodes.join(least, "label").select("node", "label", "component_id", "size"), "nodes")
    common.release(label, edges)
    # sets that one in ``HOT`` rows has, at most so many, reach their rows by broadcast; empty sets need no join
    large = nodes.where(F.col("size") * HOT >= base.count()).drop("size")
    own = base.where("n > 0").join(F.broadcast(large), "node", "left")
    cold = own.where("label is null").drop("label", "component_id").join(nodes.drop("size"), "node", "left")
    none = base.where("n = 0").withColumns({"label": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    rows = own.where("label is not null").unionByName(cold).unionByName(none)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("label").alias("component_node"), "node")


def distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id. Texts without words and rows with a null id stay.

    The dropped ids are broadcast only below ``BROADCAST_ROWS``, else joined. Where ids repeat, rows are told apart
    by their sets, and of equal rows one stays.
    """
    found = common.written(join(docs, id_col, text_col).where("doc_id is not null and n_shingles > 0"), "components")
    stay = found.groupBy("component_node").agg(F.min(F.struct("doc_id", "node")).alias("keep")).select("component_node", "keep.*")
    once = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").limit(1).count() == 0
    key = docs[id_col].cast("long")
    if once:
        # ids are unique, so the row that stays is that of the component's id: no join
        dropped = common.written(found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")), "dropped")
        out = F.broadcast(dropped) if dropped.count() <= BROADCAST_ROWS else dropped
        return docs.join(out, key == out["__gone"], "left_anti")
    at, names = docs.columns.index(text_col), docs.columns

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = [_node(s) for _, s in _sets(batch, batch.schema.names[at])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node, pa.int64())], [*names, "__node"])

    rows = docs.mapInArrow(common.lean(named), T.StructType([*docs.schema.fields, T.StructField("__node", T.LongType())]))
    other = F.col(id_col).isNull() | (F.col("__node") == _node(np.zeros(0, np.uint64)))
    ours = stay.select(F.col("doc_id").alias("__id"), F.col("node").alias("__n")).distinct()
    kept = rows.where(~other).join(ours, (F.col(id_col).cast("long") == F.col("__id")) & (F.col("__node") == F.col("__n")), "left_semi")
    return kept.dropDuplicates([id_col, "__node"]).unionByName(rows.where(other)).drop("__node")
