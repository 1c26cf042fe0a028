"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; every run of other characters than letters is one space. Character n-grams of 1
to ``N_MAX`` are hashed into ``BUCKETS``; a feature is (1 + log tf) * idf, the vector scaled to unit
length. Document frequencies are counted over all documents that may be learned from. Weights are
trained by follow-the-regularised-leader with elastic-net penalties (L1 leaves most weights at zero)
on a sample: the ``PER_LANGUAGE`` documents of each language with the smallest hash of their id (all of a
language with fewer), the one bound there is. Whole texts are counted in Spark tasks; the driver gets their
n-gram counts, at most ``BUCKETS`` a text. One temperature, fitted on a fifth of each language's sample,
calibrates the probabilities.

Learned from: text and non-null lang of documents whose crc32(id as text) modulo 5 is not 0 (a null id
is held out). Null text, or one without letters, is ``und`` with score 0. Without any label every text
is ``und``; with one label all others have it, with score 1. Repeated rows are predicted each; ties go
to the label that sorts first; extra columns have no effect; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from . import common
from .token_files import text_chunks

N_MAX, BUCKETS = 3, 1 << 14
PER_LANGUAGE, HASH_BITS = 800, 30
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.05, 1e-3, 4
SEGMENT = 1 << 20
OTHER = regex.compile(r"\P{L}+")   # everything but letters: marks, digits, fractions, number forms


def normal(text: str) -> str:
    return " " + OTHER.sub(" ", text.lower()).strip() + " "


def frequencies(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a normalised text, made in segments of bounded size."""
    out = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(text), SEGMENT):
        code = np.frombuffer(text[at:at + SEGMENT + N_MAX - 1].encode("utf-32-le"), np.uint32).astype(np.uint64)
        h = np.zeros(len(code), np.uint64)
        for n in range(1, N_MAX + 1):
            h = h[:len(code) - n + 1] * np.uint64(0x100000001B3) + code[n - 1:] + np.uint64(1)
            own = h[:SEGMENT]
            if n == 1:
                own = own[code[:len(own)] != 32]
            x = own * np.uint64(0x9E3779B97F4A7C15)
            out += np.bincount((x >> np.uint64(50)).astype(np.int64), minlength=BUCKETS)
    return out


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(counts)
    v = (1 + np.log(counts[at])) * idf[at]
    n = np.sqrt((v * v).sum())
    return at, v / n if n else v


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Model:
    def __init__(self, names: list[str], idf: np.ndarray):
        self.names, self.idf, self.temperature = names, idf, 1.0
        self.weights = np.zeros((BUCKETS + 1, len(names)))

    def fit(self, rows: "Sample", y: np.ndarray, check: np.ndarray) -> "Model":
        """FTRL-proximal, one document at a time, with L1 and L2 penalties; the last row is the intercept."""
        z, n = np.zeros_like(self.weights), np.zeros_like(self.weights)
        rng, learn = np.random.default_rng(11), np.flatnonzero(~check)
        for _ in range(EPOCHS):
            for i in rng.permutation(learn):
                at, v = rows[i]
                at, v = np.r_[at, BUCKETS], np.r_[v, 1.0]
                w = self._solve(z[at], n[at])
                p = _softmax(v @ w)
                p[y[i]] -= 1
                g = np.outer(v, p)
                sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
                z[at] += g - sigma * w
                n[at] += g * g
        self.weights = self._solve(z, n)
        if check.any():
            logit = np.stack([self.logit(*rows[i]) for i in np.flatnonzero(check)])
            t, grid = y[check], np.exp(np.linspace(np.log(0.05), np.log(8), 100))
            loss = [-np.log(_softmax(logit / k)[np.arange(len(t)), t] + 1e-12).mean() for k in grid]
            self.temperature = float(grid[int(np.argmin(loss))])
        return self

    @staticmethod
    def _solve(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def logit(self, at: np.ndarray, v: np.ndarray) -> np.ndarray:
        return v @ self.weights[at] + self.weights[BUCKETS]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.names or not text:
            return "und", 0.0
        t = normal(text)
        if not t.strip():
            return "und", 0.0
        p = _softmax(self.logit(*vector(frequencies(t), self.idf)) / self.temperature)
        k = int(np.argmax(p))
        return self.names[k], float(p[k])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts hold each bucket, over all rows: BUCKETS sums, whatever the input."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for _, texts in text_chunks(batch.column("text")):
                for t in texts:
                    if t:
                        total += frequencies(normal(t)) > 0
                        n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, BUCKETS].astype(np.int64)), pa.array(np.r_[total[at], n].astype(np.int64))], ["b", "n"])

    got = docs.select("text").mapInArrow(task, "b long, n long").groupBy("b").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(BUCKETS + 1, np.int64)
    df[got["b"].to_numpy(int)] = got["n"].to_numpy(np.int64)
    return df[:-1], int(df[-1])


def packed_counts(counts: np.ndarray) -> tuple[bytes, bytes]:
    """The buckets that a text has, and their counts in the least width that holds them."""
    at = np.flatnonzero(counts)
    n = counts[at]
    return at.astype("<u2").tobytes(), n.astype(np.min_scalar_type(int(n.max(initial=0)))).tobytes()


class Sample:
    """The vectors of packed counts, made when asked for."""

    def __init__(self, at: list[bytes], counts: list[bytes], idf: np.ndarray):
        self.at, self.counts, self.idf = at, counts, idf

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        counts, at = np.zeros(BUCKETS, np.int64), np.frombuffer(self.at[i], "<u2")
        if len(at):
            counts[at] = np.frombuffer(self.counts[i], f"<u{len(self.counts[i]) // len(at)}")
        return vector(counts, self.idf)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, texts in text_chunks(batch.column("text")):
            found = [packed_counts(frequencies(normal(t))) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(k).slice(at, len(texts)) for k in ("lang", "u", "doc_id")] + [
                pa.array([x[j] for x in found], pa.binary()) for j in (0, 1)], ["lang", "u", "doc_id", "buckets", "counts"])


def sample(known: DataFrame, levels: dict[str, dict[int, int]], per_language: int) -> DataFrame:
    """lang, rank, u, buckets and counts of the ``per_language`` rows of each language with the least (u, doc_id).

    ``levels``: rows of each language by the bit length of u. All rows up to the first length that has enough are
    counted in tasks, for unique ids about twice as many as wanted at most; then they are ranked.
    """
    upto = {}
    for lang, by_level in levels.items():
        total = 0
        for k in sorted(by_level):
            upto[lang], total = k, total + by_level[k]
            if total >= per_language:
                break
    last = F.create_map(*[F.lit(x) for pair in upto.items() for x in pair])
    rows = known.where(F.col("level") <= F.element_at(last, F.col("lang"))).select("lang", "u", "doc_id", "text")
    counted = rows.mapInArrow(_count, "lang string, u long, doc_id long, buckets binary, counts binary")
    order = Window.partitionBy("lang").orderBy("u", "doc_id", "buckets", "counts")
    return (counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)
            .select("lang", "rank", "u", "buckets", "counts"))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    uniform = F.pmod(F.xxhash64("doc_id"), F.lit(1 << HASH_BITS))
    known = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.col("lang").cast("string").alias("lang"))
             .where("lang is not null and text is not null").where(~common.held_out(F.col("doc_id")))
             .withColumn("u", uniform).withColumn("level", F.length(F.bin("u"))))
    df, total = document_frequencies(known)
    idf = np.log((1 + total) / (1 + df)) + 1
    levels: dict[str, dict[int, int]] = {}
    for r in known.groupBy("lang", "level").agg(F.count(F.lit(1)).alias("n")).collect():  # at most HASH_BITS rows a language
        levels.setdefault(r["lang"], {})[r["level"]] = r["n"]
    model = Model(sorted(levels), idf)
    if not levels:
        return model
    rows = sample(known, levels, per_language).toArrow().to_pandas().sort_values(["u", "lang", "rank"])
    y = rows["lang"].map({k: i for i, k in enumerate(model.names)}).to_numpy(int)
    return model.fit(Sample(rows["buckets"].tolist(), rows["counts"].tolist(), idf), y, rows["rank"].to_numpy() % 5 == 0)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages weights

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at, texts in text_chunks(batch.column("text")):
                found = [m.predict(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(at, len(texts)), batch.column("held_out").slice(at, len(texts)),
                    pa.array([k for k, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.held_out(F.col("doc_id").cast("long")).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, "doc_id long, held_out boolean, lang_pred string, score double")
