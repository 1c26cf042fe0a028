"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Tokens are runs of letters (lower-cased), runs of digits, and runs of one punctuation mark; each run of
letters also gives a token for its shape (upper, title, lower, mixed), marks and digits one for theirs. A token's *index vector* is
sparse, with entries +1 and -1 chosen by its hash. Its *word vector* is its index vector plus, scaled,
the sum of the index vectors of its neighbours in the fit sample's texts (random indexing); tokens share
``BUCKETS`` hash buckets. A document is pooled into the mean of its tokens' word vectors, weighted by
1 + log(count), next to a few rates (shapes, length, distinct words, words that repeat the one before). A two-layer numpy network
gives a logit, and one temperature, fitted on a fifth of the sample, calibrates its probability.

The fit takes a bounded sample of the labelled rows: ``FIT_ROWS`` of those not held out with the
smallest hash of their id (the one bound, documented; fit and scoring cover every whole text: the sample is
read in Spark tasks, and the driver gets sums of fixed size and one vector a row). Held out: crc32 of the
id as text, modulo 5, is 0; a null id is held out. Null text scores as empty. Labels that are null or
contradict each other for an id are not learned. Repeated rows are scored each. With fewer than two
classes to learn from, the score is the share of label 1 (0.5 without labels). Extra columns have no
effect; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common
from .token_files import text_chunks

DIM, NONZERO, BUCKETS, WINDOW = 64, 6, 1 << 14, 2
HIDDEN, EPOCHS, RATE, DECAY = 32, 60, 3e-3, 1e-4
FIT_ROWS, FLUSH = 4000, 1 << 20
THRESHOLD = 0.3
SEGMENT, KNOWN_CHUNKS = 1 << 20, 300_000
TOKEN = re.compile(r"[^\W\d_]+|\d+|([^\w\s]|_)\1*")
UPPER, TITLE, LOWER, MIXED, MARK, MARKS, DIGITS = range(7)  # the buckets of shapes; hashed ones follow
SHAPES, RATES = 7, 12


def _hashed() -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the entries of every bucket's index vector."""
    at = common.mix(np.arange(1, BUCKETS * NONZERO + 1, dtype=np.uint64)).reshape(BUCKETS, NONZERO)
    return (at % np.uint64(DIM)).astype(np.int64), np.where(at >> np.uint64(40) & np.uint64(1), 1.0, -1.0).astype(np.float32)


def index_vectors() -> np.ndarray:
    pos, sign = _hashed()
    out = np.zeros((BUCKETS, DIM), np.float32)
    np.add.at(out, (np.arange(BUCKETS)[:, None], pos), sign)
    return out


def _shape(token: str) -> int:
    if token[0].isdigit():
        return DIGITS
    if not token[0].isalpha():
        return MARKS if len(token) > 1 else MARK
    return LOWER if token.islower() else UPPER if token.isupper() and len(token) > 1 else TITLE if token.istitle() else MIXED


class Chunks(dict):
    """The buckets of a run of non-space characters: each token's own and its shape's. Bounded."""

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        if len(self) >= KNOWN_CHUNKS:
            self.clear()
        out = []
        for m in TOKEN.finditer(chunk):
            t = m.group()
            body = t.lower() if t[0].isalnum() else t[0] + "~"
            out += (SHAPES + zlib.crc32(body.encode()) % (BUCKETS - SHAPES), _shape(t))
        self[chunk] = out = tuple(out)
        return out


def _segments(text: str) -> Iterator[list[str]]:
    """The text's chunks in lists of bounded size."""
    at = 0
    while at < len(text):
        to = at + SEGMENT
        while to < len(text) and not text[to].isspace():
            to += 1
        yield text[at:to].split()
        at = to


def pooled(text: str | None, chunks: Chunks, vectors: np.ndarray) -> np.ndarray:
    """The weighted mean of a text's word vectors, and its rates."""
    text = text or ""
    counts, n, repeats = Counter(), 0, 0
    for words in _segments(text):
        counts.update(words)
        n += len(words)
        repeats += sum(map(eq, words, islice(words, 1, None)))
    out = np.zeros(DIM + RATES, np.float32)
    if not n:
        return out
    each = [chunks[c] for c in counts]
    at = np.fromiter(chain.from_iterable(each), np.int64)
    size = np.fromiter(map(len, each), np.int64, len(each))
    count = np.fromiter(counts.values(), np.float64, len(each))
    weight = np.repeat(1 + np.log(count), size).astype(np.float32)
    if len(at):
        out[:DIM] = weight @ vectors[at] / weight.sum()
        shape = np.bincount(np.minimum(at, SHAPES), np.repeat(count, size), SHAPES + 1)
        out[DIM:DIM + SHAPES] = shape[:SHAPES] / shape[SHAPES]
    out[DIM + SHAPES:] = [np.log1p(len(text)), np.log1p(n), len(counts) / n, repeats / n, count.max() / n]
    return out


class Model:
    """Word vectors, standardisation, the two layers and the temperature."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.prior: float | None = 0.5
        self.temperature = 1.0

    def fit(self, x: np.ndarray, y: np.ndarray, check: np.ndarray) -> "Model":
        if len(y):
            self.prior = float(y.mean())
        if len(set(y.tolist())) < 2 or len(set(y[~check].tolist())) < 2:
            return self
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = ((x - self.mean) / self.scale).clip(-8, 8)
        rng = np.random.default_rng(7)
        d = z.shape[1]
        p = [rng.normal(0, (2 / d) ** 0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(())]
        m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
        a, b, step = z[~check], y[~check].astype(float), 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(b))
            for at in range(0, len(b), 128):
                i = order[at:at + 128]
                h = a[i] @ p[0] + p[1]
                r = np.maximum(h, 0)
                e = (1 / (1 + np.exp(-(r @ p[2] + p[3]).clip(-30, 30))) - b[i]) / len(i)
                back = np.outer(e, p[2]) * (h > 0)
                grads = [a[i].T @ back + DECAY * p[0], back.sum(0), r.T @ e + DECAY * p[2], e.sum()]
                step += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        self.layers, self.prior = p, None
        if check.any() and len(set(y[check].tolist())) == 2:
            logit, t = self.logits(x[check]), y[check]
            grid = np.exp(np.linspace(np.log(0.2), np.log(8), 80))
            loss = [np.mean(np.logaddexp(0, logit / k) - t * logit / k) for k in grid]
            self.temperature = float(grid[int(np.argmin(loss))])
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale).clip(-8, 8)
        w1, b1, w2, b2 = self.layers
        return np.maximum(z @ w1 + b1, 0) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-(self.logits(x) / self.temperature).clip(-30, 30)))


class Contexts:
    """For every bucket, the sum of the index vectors of its neighbours: whole numbers, the same in any order."""

    def __init__(self):
        self.chunks, (self.pos, self.sign) = Chunks(), _hashed()
        self.total = np.zeros(BUCKETS * DIM)
        self.ids: list[np.ndarray] = []
        self.held, self.tail = 0, np.zeros(0, np.int64)

    def add(self, text: str) -> None:
        for words in _segments(text):
            ids = np.fromiter(chain.from_iterable(map(self.chunks.__getitem__, words)), np.int64)
            self._put(ids[ids >= SHAPES])
        self._put(np.full(WINDOW, -1))  # no neighbours across texts

    def _put(self, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.held += len(ids)
        if self.held > FLUSH:
            self._flush()

    def _flush(self) -> None:
        flat, done = np.concatenate([self.tail, *self.ids]), len(self.tail)
        for k in range(1, WINDOW + 1):
            at = max(done, k)  # pairs whose later one is new
            a, b = flat[at - k:len(flat) - k], flat[at:]
            both = (a >= 0) & (b >= 0)
            self._pairs(a[both], b[both])
            self._pairs(b[both], a[both])
        self.ids, self.held, self.tail = [], 0, flat[-WINDOW:]

    def _pairs(self, near: np.ndarray, far: np.ndarray) -> None:
        for j in range(NONZERO):
            np.add(self.total, np.bincount(near * DIM + self.pos[far, j], self.sign[far, j], BUCKETS * DIM), out=self.total)

    def sums(self) -> np.ndarray:
        self._flush()
        return self.total.reshape(BUCKETS, DIM)


def _sums(rows: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(rows.any(1))
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([r.tobytes() for r in rows[at]], pa.binary())], ["bucket", "sums"])


def contexts(sample: DataFrame) -> np.ndarray:
    """``Contexts`` of all texts of a table: BUCKETS x DIM numbers, whatever their length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Contexts()
        for batch in batches:
            for _, texts in text_chunks(batch.column("text")):
                for t in texts:
                    own.add(t)
        yield _sums(own.sums())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, DIM))
        for batch in batches:
            for k, sums in zip(batch.column("bucket").to_pylist(), batch.column("sums").to_pylist()):
                total[k] += np.frombuffer(sums)
        yield _sums(total)

    kind, out = "bucket int, sums binary", np.zeros((BUCKETS, DIM))
    got = sample.select("text").mapInArrow(common.lean(count), kind).repartition("bucket").mapInArrow(common.lean(add), kind).toArrow()
    for k, sums in zip(got.column("bucket").to_pylist(), got.column("sums").to_pylist()):
        out[k] = np.frombuffer(sums)
    return out


def word_vectors(context: np.ndarray) -> np.ndarray:
    """Random indexing over the sample: each bucket's index vector plus its neighbours' (both scaled)."""
    context = context.astype(np.float32)
    length = np.linalg.norm(context, axis=1, keepdims=True)
    return index_vectors() / NONZERO ** 0.5 + context / np.maximum(length, 1e-6)


def _pooled_rows(sample: DataFrame, vectors: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """The pooled vector of each (doc_id, t) of the sample."""
    shared = sample.sparkSession.sparkContext.broadcast(vectors)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks()
        for batch in batches:
            for at, texts in text_chunks(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), batch.column("t").slice(at, len(texts)),
                                                  pa.array([pooled(t, chunks, shared.value).tobytes() for t in texts], pa.binary())], ["doc_id", "t", "x"])

    got = sample.select("doc_id", "t", "text").mapInArrow(common.lean(task), "doc_id long, t long, x binary").toArrow().to_pydict()
    return {(i, t): np.frombuffer(x, np.float32) for i, t, x in zip(got["doc_id"], got["t"], got["x"])}


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``fit_rows`` labelled rows that aren't held out."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
             .where("doc_id is not null and y in (0, 1)").where(~common.held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z")
             .select("doc_id", "y", F.xxhash64("doc_id").alias("h")))
    chosen = known.orderBy("h", "doc_id").limit(fit_rows)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = own.join(F.broadcast(chosen), "doc_id").withColumn("t", F.xxhash64("text"))
    # equal rows are read once and counted as often as they are there; a text stays in its task until it is chosen
    keys = own.groupBy("h", "doc_id", "t", "y").agg(F.count(F.lit(1)).alias("n")).orderBy("h", "doc_id", "t").limit(fit_rows).collect()
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(r["doc_id"], r["t"]) for r in keys], "doc_id long, t long")
    sample = common.written(own.select("doc_id", "t", "text").join(F.broadcast(wanted), ["doc_id", "t"], "left_semi")
                            .groupBy("doc_id", "t").agg(F.min("text").alias("text")), "quality")
    vectors = word_vectors(contexts(sample))
    found = _pooled_rows(sample, vectors)
    times = np.array([r["n"] for r in keys], np.int64)
    times = np.diff(np.minimum(np.cumsum(times), fit_rows), prepend=0)
    x = np.stack([found[r["doc_id"], r["t"]] for r in keys]) if keys else np.zeros((0, DIM + RATES), np.float32)
    x, y = np.repeat(x, times, 0), np.repeat(np.array([r["y"] for r in keys], int), times)
    check = np.arange(len(y)) % 5 == 4
    return Model(vectors).fit(x, y, check)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # BUCKETS x DIM floats: about 4 MB, whatever the input

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, chunks = shared.value, Chunks()
        for batch in batches:
            for at, texts in text_chunks(batch.column("text")):
                x = np.stack([pooled(t, chunks, m.vectors) for t in texts])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)),
                                                  batch.column("held_out").slice(at, len(texts)), pa.array(m.score(x).astype(float))],
                                                 ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.held_out(F.col("doc_id").cast("long")).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(common.lean(task), "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns as they are."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, chunks = shared.value, Chunks()
        for batch in batches:
            for first, texts in text_chunks(batch.column(at)):  # given out a run at a time: a batch may be large
                keep = m.score(np.stack([pooled(t, chunks, m.vectors) for t in texts])) >= threshold
                yield batch.slice(first, len(texts)).filter(pa.array(keep))

    return docs.mapInArrow(common.lean(task), docs.schema)
