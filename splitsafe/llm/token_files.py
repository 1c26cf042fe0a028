"""Token-id output: flat unsigned integer files with 64-bit document offsets, memory-mapped on reading.

Format, one shard per range of document ids (shards in ascending id order, documents in ascending id
order inside a shard, rows of one id in the order of a 64-bit hash of their texts, so that only equal texts tie):

* ``<shard>.ids``  token ids of all documents, end id after each; uint16 if the vocabulary fits, else uint32
* ``<shard>.off``  n + 1 little-endian uint64: where each document begins in the shard, and the shard's length
* ``<shard>.doc``  n little-endian int64 document ids (a null id is stored as -2**63 and sorts first)
* ``manifest``     Parquet, one row a shard: shard, n_docs, n_tokens, base (ids in all shards before it)

``base`` is a prefix sum over the manifest, so a document's place in the whole corpus is base + offset.
Each task writes under a name of its own and renames at the end: a repeated or speculative attempt
cannot leave a half-written shard. A null text is an empty one; an empty table has an empty manifest.
Only the id and text columns are read; extra columns have no effect. A very long text is encoded alone,
in memory of a small multiple of its size.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import common, tokens

NULL_ID = -(1 << 63)
CHUNK_CHARS = 2_000_000


def text_chunks(column: pa.Array, chars: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) in runs of about ``chars`` characters, so that a batch is never expanded at once."""
    at, size, run = 0, 0, []
    for i in range(len(column)):
        t = column[i].as_py()
        run.append(t)
        size += len(t or "")
        if size >= chars:
            yield at, run
            at, size, run = i + 1, 0, []
    if run:
        yield at, run


def _open(uri: str):
    path = common.local_path(uri)
    return (pafs.LocalFileSystem(), path) if path else pafs.FileSystem.from_uri(uri)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
          text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Encode every text and write the files; returns the manifest (shard, n_docs, n_tokens, base)."""
    spark = docs.sparkSession
    n = shards or common.partitions_for(spark)
    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
               .withColumn("tie", F.xxhash64("text")).repartitionByRange(n, "id").sortWithinPartitions("id", "tie").drop("tie"))

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, store, base = tokens.encoder(tokenizer), *_open(folder)
        width, total, offsets, docs_ = enc.dtype.itemsize, 0, [np.zeros(1, np.int64)], []
        name, own = f"{base}/{TaskContext.get().partitionId():08d}", uuid.uuid4().hex
        out = None
        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{name}.ids.{own}")
            docs_.append(batch.column("id").fill_null(NULL_ID).to_numpy().astype("<i8"))
            for texts in tokens.row_chunks(batch.column("text")):
                ids, ends = enc.encode(texts)
                out.write(np.insert(ids, ends, end_id).tobytes())
                ends = total + ends + np.arange(1, len(ends) + 1)
                offsets.append(ends)
                total = int(ends[-1])
        if out is None:
            return
        out.close()
        offsets = np.concatenate(offsets).astype("<u8")
        for suffix, data in (("off", offsets), ("doc", np.concatenate(docs_))):
            with store.open_output_stream(f"{name}.{suffix}.{own}") as f:
                f.write(data.tobytes())
        for suffix in ("ids", "off", "doc"):
            store.move(f"{name}.{suffix}.{own}", f"{name}.{suffix}")
        yield pa.RecordBatch.from_pydict({"shard": [TaskContext.get().partitionId()], "n_docs": [len(offsets) - 1],
                                          "n_tokens": [total], "width": [width]})

    found = ordered.mapInArrow(shard, "shard long, n_docs long, n_tokens long, width long")
    found.write.parquet(f"{folder}/shards")
    sums = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    (spark.read.parquet(f"{folder}/shards").withColumn("base", F.coalesce(F.sum("n_tokens").over(sums), F.lit(0)))
     .write.parquet(f"{folder}/manifest"))
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")


def _map(uri: str, dtype: str) -> np.ndarray:
    path = common.local_path(uri)
    if path:
        import os
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    store, name = pafs.FileSystem.from_uri(uri)
    with store.open_input_file(name) as f:
        return np.frombuffer(f.read(), dtype)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every document from the files: doc_id, start (ids of all documents before it), n_tokens (with the end
    id), ids (binary: little-endian unsigned 32-bit)."""
    schema = "doc_id long, start long, n_tokens long, ids binary"

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{folder}/{row['shard']:08d}"
                ids, off, doc = _map(f"{name}.ids", f"<u{row['width']}"), _map(f"{name}.off", "<u8"), _map(f"{name}.doc", "<i8")
                at = 0
                while at < len(doc):  # a few million ids a batch
                    to = max(at + 1, int(np.searchsorted(off, off[at] + np.uint64(1 << 20), "right")) - 1)
                    to = min(to, len(doc))
                    own = off[at:to + 1].astype(np.int64)
                    flat = np.asarray(ids[own[0]:own[-1]]).astype("<u4").tobytes()
                    cut = (own - own[0]) * 4
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.asarray(doc[at:to]), mask=np.asarray(doc[at:to]) == NULL_ID), pa.array(own[:-1] + row["base"]),
                        pa.array(np.diff(own)), pa.array([flat[i:j] for i, j in zip(cut, cut[1:])], pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"])
                    at = to

    shards = manifest(spark, folder)
    return shards.repartition(common.partitions_for(spark), "shard").mapInArrow(documents, schema)
