"""Approximate nearest neighbours by cosine: NN-descent builds the graph, queries search it greedily.

Equal vectors are one node (named by the smallest id), so a vector that fills a third of the table is one
node too; its ``k + 1`` smallest ids are all that a result of ``k`` can need. Vectors that are null, zero, hold
null or non-finite components, or have another length than most, take no part; nor do rows with a null id.

*Start.* Nodes that share the signs of a few random projections meet in groups of bounded size, in several
rounds; each keeps its ``degree`` best. *NN-descent.* In each round every node's neighbours (its own, and those
that have it) are joined to it with their vectors, are compared with each other, and whoever finds a better
neighbour keeps it; pairs compared before are skipped; it ends after ``rounds`` or when few lists change.
*Search.* A query starts from its own node (if it is one) and from fixed seeds, expands the best nodes of its
beam that aren't yet expanded, joins the vectors of their neighbours and of those that have them, and keeps the ``beam`` best. The last beam is
scored anew in double precision on the original vectors and expanded to ids.

Ties go to the smaller id. A table with fewer candidates gives fewer ranks; an empty one gives no rows. Rows
that repeat an id with equal vectors count once; an id should not have two vectors. Extra columns have
no effect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import common

DEGREE, ROUNDS, BEAM, EXPAND, STEPS, SEEDS = 24, 5, 256, 64, 12, 16
CELL, TREES, SALTS = 96, 8, 64
QUERY_BLOCK = 20_000


def _floats(column, at: int | None = None) -> np.ndarray:
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Nodes:
    """The distinct vectors of a table: vectors (node, v), codes (node, code: unit vector in half precision), members."""

    def __init__(self, table: DataFrame, id_col: str, vec_col: str, k: int):
        rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<float>").alias("v")).where("id is not null and v is not null")
        rows = rows.where("not exists(v, x -> x is null or isnan(x) or abs(x) = float('infinity')) and exists(v, x -> x <> 0)")
        sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
        self.dim = sizes[0]["n"] if sizes else 0
        self.rows = common.written(rows.where(F.size("v") == self.dim), "vectors")
        self.vectors = common.written(self.rows.groupBy("v").agg(F.min("id").alias("node")).select("node", "v"), "nodes")
        self.k = k

    def members(self) -> DataFrame:
        """(node, id): the k + 1 smallest ids of each node, chosen in two steps so that no group is whole in a task."""
        own = self.rows.join(self.vectors, "v").select("node", "id").distinct()
        salted = Window.partitionBy("node", F.pmod(F.xxhash64("id"), F.lit(SALTS))).orderBy("id")
        few = own.withColumn("r", F.row_number().over(salted)).where(F.col("r") <= self.k + 1).select("node", "id")
        return few.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy("id"))).where(F.col("r") <= self.k + 1).select("node", "id")

    def codes(self) -> DataFrame:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    code = _unit(_floats(b.column("v"))).astype(np.float16)
                    yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([r.tobytes() for r in code], pa.binary())], ["node", "code"])

        return common.written(self.vectors.mapInArrow(task, "node long, code binary"), "codes")


def _best(rows: DataFrame, degree: int) -> DataFrame:
    """(node, near): the ``degree`` best of rows (node, s, b, fresh); an old entry stays old."""
    one = rows.groupBy("node", "b").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    top = F.slice(F.sort_array(F.collect_list(F.struct("s", "b", "fresh")), asc=False), 1, degree)
    return one.groupBy("node").agg(top.alias("near"))


def both_ways(graph: DataFrame, degree: int) -> DataFrame:
    """The graph that is searched: each node's neighbours and those that have it, the ``degree`` best.

    In two steps, so that a node that very many have isn't gathered whole in one task.
    """
    edges = graph.select("node", F.explode("near").alias("x")).select("node", "x.s", "x.b", F.lit(False).alias("fresh"))
    back = edges.select(F.col("b").alias("node"), "s", F.col("node").alias("b"), "fresh")
    top = lambda xs: F.slice(F.sort_array(xs, asc=False), 1, degree)
    few = (edges.unionByName(back).distinct().groupBy("node", F.pmod(F.xxhash64("b"), F.lit(SALTS)).alias("salt"))
           .agg(top(F.collect_list(F.struct("s", "b", "fresh"))).alias("xs")))
    return common.written(few.groupBy("node").agg(top(F.flatten(F.collect_list("xs"))).alias("near")), "graph")


def _pairs(nodes: list, codes: np.ndarray, kth: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whoever of a list gains a better neighbour in it: (node, neighbour, similarity)."""
    s = codes @ codes.T
    want = (s > kth[:, None]) & (fresh[:, None] | fresh[None])
    np.fill_diagonal(want, False)
    i, j = np.nonzero(want)
    return nodes[i], nodes[j], s[i, j]


def _compare(fan: int):
    """Rows (list of structs node, code, kth, fresh): emits better neighbours, at most ``fan`` per member and list."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(0)
            flat, offsets = col.flatten(), np.r_[0, np.cumsum(col.value_lengths().to_numpy(zero_copy_only=False))]
            node = flat.field("node").to_numpy(zero_copy_only=False)
            kth = flat.field("kth").to_numpy(zero_copy_only=False)
            fresh = flat.field("fresh").to_numpy(zero_copy_only=False)
            code = np.frombuffer(b"".join(flat.field("code").to_pylist()), np.float16).astype(np.float32).reshape(len(node), -1) if len(node) else None
            out = []
            for i, j in zip(offsets, offsets[1:]):
                if j - i > 1:
                    out.append(_pairs(node[i:j], code[i:j], kth[i:j], fresh[i:j]))
            if out:
                x, y, s = (np.concatenate([o[k] for o in out]) for k in range(3))
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(s.astype(np.float32)), pa.array(y), pa.array(np.ones(len(x), bool))], ["node", "s", "b", "fresh"])

    return task


NEAR = "node long, s float, b long, fresh boolean"


def _start(codes: DataFrame, dim: int, count: int, degree: int) -> DataFrame:
    """The first lists, out of groups that share projection signs."""
    bits = max(0, int(np.log2(max(1, count / CELL))))
    rng = np.random.default_rng(17)
    planes = rng.normal(size=(TREES, dim, bits + 1)).astype(np.float32)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.frombuffer(b"".join(b.column("code").to_pylist()), np.float16).astype(np.float32).reshape(b.num_rows, -1)
            for t in range(TREES):
                z = x @ planes[t]
                cell = ((z[:, :bits] > 0) << np.arange(bits)).sum(1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cell + (t << 48)), pa.array(z[:, bits]), b.column("node"), b.column("code")], ["cell", "z", "node", "code"])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            while held.num_rows > 4 * CELL:
                yield from one(held.slice(0, CELL))
                held = held.slice(CELL)
        while held is not None and held.num_rows:
            yield from one(held.slice(0, CELL))
            held = held.slice(CELL)

    def one(t: pa.Table) -> Iterator[pa.RecordBatch]:
        node = t.column("node").to_numpy()
        x = np.frombuffer(b"".join(t.column("code").to_pylist()), np.float16).astype(np.float32).reshape(len(node), -1)
        s = x @ x.T
        np.fill_diagonal(s, -2)
        k = min(degree, len(node) - 1)
        if k > 0:
            top = np.argpartition(-s, k - 1, axis=1)[:, :k]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(node, k)), pa.array(np.take_along_axis(s, top, 1).ravel().astype(np.float32)),
                                              pa.array(node[top].ravel()), pa.array(np.ones(k * len(node), bool))], ["node", "s", "b", "fresh"])

    spark = codes.sparkSession
    # rows of a tree in order of cell and projection; consecutive runs of CELL rows meet, whatever a cell's size
    dealt = (codes.mapInArrow(cells, "cell long, z float, node long, code binary")
             .repartitionByRange(common.partitions_for(spark), "cell", "z", "node").sortWithinPartitions("cell", "z", "node"))
    return _best(dealt.mapInArrow(groups, NEAR), degree)


def build(codes: DataFrame, dim: int, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """The neighbour graph: (node, near: array of s, b, fresh), best first."""
    count = codes.count()
    graph = common.written(_start(codes, dim, count, degree), "graph")
    for _ in range(rounds):
        edges = graph.select("node", F.explode("near").alias("x")).select("node", F.col("x.b").alias("b"), F.col("x.fresh").alias("fresh"))
        # those that have a node, by the order of a hash; in two steps, as a node may be in very many lists
        back = edges.where("fresh").select(F.col("b").alias("node"), F.struct(F.xxhash64("node", "b").alias("h"), F.col("node").alias("b")).alias("x"))
        some = F.slice(F.sort_array(F.collect_list("x")), 1, degree)
        back = back.groupBy("node", F.pmod(F.col("x.h"), F.lit(SALTS)).alias("salt")).agg(some.alias("xs"))
        back = back.groupBy("node").agg(F.slice(F.sort_array(F.flatten(F.collect_list("xs"))), 1, degree).alias("xs"))
        back = back.select("node", F.explode("xs").alias("x")).select("node", F.col("x.b").alias("b"), F.lit(True).alias("fresh"))
        lists = edges.unionByName(back).groupBy("node", "b").agg(F.max("fresh").alias("fresh"))
        lists = lists.withColumn("some", F.max("fresh").over(Window.partitionBy("node"))).where("some")
        kth = graph.select("node", F.when(F.size("near") < degree, F.lit(-2.0)).otherwise(F.col("near")[degree - 1]["s"]).cast("float").alias("kth"))
        known = codes.join(kth, "node")
        joined = lists.select(F.col("node").alias("centre"), F.col("b").alias("node"), "fresh").join(known, "node")
        met = joined.groupBy("centre").agg(F.collect_list(F.struct("node", "code", "kth", "fresh")).alias("xs")).select("xs")
        found = met.mapInArrow(_compare(degree), NEAR)
        old = graph.select("node", F.explode("near").alias("x")).select("node", "x.s", "x.b", F.lit(False).alias("fresh"))
        graph = common.written(_best(old.unionByName(found), degree), "graph")
        changed = graph.agg(F.sum(F.expr("size(filter(near, x -> x.fresh))"))).first()[0] or 0
        if changed < 0.005 * degree * count:
            break
    return graph


def search(queries: DataFrame, codes: DataFrame, graph: DataFrame, beam: int = BEAM, expand: int = EXPAND, steps: int = STEPS) -> DataFrame:
    """(q, node): the last beam of each query (q, code; start: its own node or null)."""
    spark = queries.sparkSession
    seeds = [r["node"] for r in codes.select("node").orderBy(F.xxhash64("node"), "node").limit(SEEDS).collect()]
    own = queries.collect()  # a block of at most QUERY_BLOCK queries
    names = np.array([r["q"] for r in own], np.int64)
    order = np.argsort(names)
    matrix = np.stack([np.frombuffer(own[i]["code"], np.float16).astype(np.float32) for i in order])
    shared = spark.sparkContext.broadcast((names[order], matrix))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, m = shared.value
        for b in batches:
            if b.num_rows:
                q = b.column("q").to_numpy(zero_copy_only=False)
                x = np.frombuffer(b"".join(b.column("code").to_pylist()), np.float16).astype(np.float32).reshape(b.num_rows, -1)
                s = np.einsum("ij,ij->i", x, m[np.searchsorted(known, q)])
                yield pa.RecordBatch.from_arrays([b.column("q"), pa.array(s), b.column("node"), pa.array(np.zeros(b.num_rows, bool))], ["q", "s", "b", "done"])

    def score(asked: DataFrame) -> DataFrame:
        return asked.join(codes, "node").select("q", "node", "code").mapInArrow(scored, "q long, s float, b long, done boolean")

    def keep(rows: DataFrame) -> DataFrame:
        one = rows.groupBy("q", "b").agg(F.max("s").alias("s"), F.max("done").alias("done"))
        return one.groupBy("q").agg(F.slice(F.sort_array(F.collect_list(F.struct("s", "b", "done")), asc=False), 1, beam).alias("near"))

    first = queries.select("q", F.explode(F.array_distinct(F.concat(F.array(*map(F.lit, seeds)), F.array("start")))).alias("node")).where("node is not null")
    state = common.written(keep(score(first)), "beam")
    for _ in range(steps):
        todo = F.slice(F.expr("filter(near, x -> not x.done)"), 1, expand)
        chosen = state.select("q", F.explode(todo).alias("x")).select("q", F.col("x.b").alias("node"))
        asked = chosen.join(graph, "node").select("q", F.explode("near").alias("x")).select("q", F.col("x.b").alias("node")).distinct()
        old = state.select("q", F.explode("near").alias("x"), todo["b"].alias("now")).select(
            "q", "x.s", "x.b", (F.col("x.done") | F.array_contains("now", F.col("x.b"))).alias("done"))
        state = common.written(keep(old.unionByName(score(asked))), "beam")
        if not state.where(F.exists("near", lambda x: ~x["done"])).limit(1).count():
            break
    return state.select("q", F.explode("near").alias("x")).select("q", F.col("x.b").alias("node"))


def nearest(table: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", beam: int = BEAM) -> DataFrame:
    """The ``k`` nearest found of each row whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    nodes = Nodes(table, id_col, vec_col, k)
    schema = "query_id long, rank int, vec_id long, score double"
    empty = table.sparkSession.createDataFrame([], schema)
    if not nodes.dim:
        return empty
    codes = nodes.codes()
    graph = both_ways(build(codes, nodes.dim), 2 * DEGREE)
    asked = nodes.rows.where(F.pmod("id", F.lit(every)) == 0).join(nodes.vectors, "v").select(F.col("id").alias("q"), F.col("node").alias("start"), "v").distinct()
    asked = common.written(asked, "queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    members = common.written(nodes.members(), "members")
    out = empty
    for i in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == i)
        if not own.limit(1).count():
            continue
        found = search(own.join(codes.withColumnRenamed("node", "start"), "start").select("q", "start", "code"), codes, graph, beam)
        pairs = (found.join(nodes.vectors, "node").withColumnRenamed("v", "w").join(own.select("q", "v"), "q"))
        dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda s, z: s + z)
        cosine = dot(F.col("v"), F.col("w")) / (F.sqrt(dot(F.col("v"), F.col("v"))) * F.sqrt(dot(F.col("w"), F.col("w"))))
        ranked = pairs.select("q", "node", cosine.alias("score"))
        ranked = ranked.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "node"))).where(F.col("r") <= 2 * k + 2)
        ids = ranked.join(members, "node").where("id <> q")
        place = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        out = out.unionAll(ids.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
                           .select(F.col("q").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"))
    return out
