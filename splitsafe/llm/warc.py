"""WARC archives: a writer with revisit records, and a salvage reader.

Writer: one archive per task, each record a gzip member of its own. Of records with equal payloads of at
least ``min_bytes`` bytes, the one with the largest id is the response and the others revisit it; smaller
payloads are all responses. Reader: walks members (or, in an uncompressed archive, records), checks the
gzip checksum, the record's framing and its payload digest; where a check fails it searches for the next
member (or version line, wherever a cut record may have left it) that parses and passes its checks, goes on there, and reports the bytes between as a quarantined gap.

Null html is an empty payload. Null ids are written as ``x-page:null`` and read back as null; among equal
payloads they never become the response of others (nulls are smallest). Repeated rows are written each:
of rows with equal payload and equal largest id, each is a response. Extra columns have no effect.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .token_files import _open

VERSION = b"WARC/1.1"
GZIP_MAGIC = b"\x1f\x8b\x08"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "file string, at long, bytes long, record_id string, record_type string, uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
GAP = "file string, at long, bytes long, reason string"


# --- writing --------------------------------------------------------------------------------------

def record_uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_uri(page_id)),
        ("WARC-Date", "2000-01-01T00:00:00Z"), ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_uri(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def revisits(pages: DataFrame, min_bytes: int = 1000, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """(id, digest, refers_to) of the rows that revisit another: only digests, lengths and ids are shuffled."""
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    keys = (pages.select(F.col(id_col).cast("long").alias("id"), body.alias("body"))
            .select("id", F.sha1("body").alias("digest"), F.length("body").alias("n"))
            .where(F.col("n") >= min_bytes))
    first = (keys.groupBy("digest", "n").agg(F.max("id").alias("refers_to"), F.min("id").alias("low"),
                                             F.count(F.lit(1)).alias("rows"))
             .where("rows > 1").where("low < refers_to or low is null"))
    return (keys.join(first, ["digest", "n"]).where("id < refers_to")
            .select("id", "digest", "refers_to").distinct())


def write(pages: DataFrame, folder: str, min_bytes: int = 1000, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", compress: bool = True) -> DataFrame:
    """Write the archives under ``folder``; returns the manifest (file, records, bytes)."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    rows = rows.join(revisits(pages, min_bytes, id_col, payload_col), ["id", "digest"], "left").select("id", "url", "html", "refers_to")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        name = f"{base}/{TaskContext.get().partitionId():08d}.warc{'.gz' if compress else ''}"
        own, out, n, size = f"{name}.{uuid.uuid4().hex}", None, 0, 0
        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(own)
            for i in range(batch.num_rows):
                page, url, html, ref = (batch.column(k)[i].as_py() for k in range(4))
                payload = html.encode()
                data = record_bytes(page, url, payload, hashlib.sha1(payload).hexdigest(), ref)
                data = gzip_member(data) if compress else data
                out.write(data)
                n, size = n + 1, size + len(data)
        if out is not None:
            out.close()
            store.move(own, name)
            uri = folder.rstrip("/") + name[len(base):]
            yield pa.RecordBatch.from_pydict({"file": [uri], "records": [n], "bytes": [size]})

    return common.written(rows.mapInArrow(archive, "file string, records long, bytes long"), "warc-manifest")


# --- reading --------------------------------------------------------------------------------------

class Damage(ValueError):
    pass


def parse_record(data, at: int = 0) -> tuple[dict, int, int, int]:
    """Headers, first byte of the block, its length, and the end of the record that begins at ``at``."""
    if bytes(data[at:at + 7]) != b"WARC/1.":
        raise Damage("no version line")
    head_end = data.find(b"\r\n\r\n", at)   # of any length; a line without a colon shows a header that isn't one
    if head_end < 0:
        raise Damage("header not ended")
    head = {}
    for line in bytes(data[at:head_end]).split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("header line without a colon")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not head.get("content-length", "").isdigit() or "warc-type" not in head:
        raise Damage("no length or type")
    n, start = int(head["content-length"]), head_end + 4
    if bytes(data[start + n:start + n + 4]) != b"\r\n\r\n":
        raise Damage("record not closed")
    return head, start, n, start + n + 4


def to_row(head: dict, block: bytes) -> dict:
    kind, digest = head["warc-type"], head.get("warc-payload-digest", "").removeprefix("sha1:").lower()
    payload = b""
    if kind == "response":
        _, cut, payload = block.partition(b"\r\n\r\n")
        if not cut:
            raise Damage("response without an HTTP header")
        found = hashlib.sha1(payload).hexdigest()
        if digest and found != digest:
            raise Damage("payload digest differs")
        digest = found
    size = head.get("x-payload-length", "")
    if kind == "response" and size.isdigit() and int(size) != len(payload):
        raise Damage("payload length differs")
    return {"record_id": head.get("warc-record-id"), "record_type": kind, "uri": head.get("warc-target-uri"),
            "refers_to": head.get("warc-refers-to"), "payload_digest": digest or None,
            "payload_bytes": len(payload) if kind == "response" else int(size) if size.isdigit() else None, "payload": payload}


def _member(data: memoryview, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``at`` and the byte after it."""
    d, parts, pos = zlib.decompressobj(31), [], at
    while not d.eof:
        chunk = bytes(data[pos:pos + (1 << 16)])
        if not chunk:
            raise Damage("member not ended")
        try:
            parts.append(d.decompress(chunk))
        except zlib.error as e:
            raise Damage("member damaged") from e
        pos += len(chunk)
    return b"".join(parts), pos - len(d.unused_data)


def _at(data, at: int, packed: bool) -> tuple[dict, int]:
    if packed:
        text, end = _member(memoryview(data), at)
        head, start, n, stop = parse_record(text)
        if stop != len(text):
            raise Damage("member holds more than a record")
        return to_row(head, text[start:start + n]), end
    head, start, n, end = parse_record(data, at)
    return to_row(head, bytes(data[start:start + n])), end


def salvage(data, name: str = "") -> Iterator[tuple[str, dict]]:
    """("record", row) and ("gap", row) of an archive's bytes (bytes or mmap), in file order."""
    packed = data.find(GZIP_MAGIC, 0, 3) == 0 or (data.find(b"WARC/1.", 0, 7) != 0 and data.find(GZIP_MAGIC) >= 0)
    mark, at, bad, why = GZIP_MAGIC if packed else b"WARC/1.", 0, None, ""
    while at < len(data):
        try:
            row, end = _at(data, at, packed)
        except Damage as e:
            if bad is None:
                bad, why = at, str(e)
            at = data.find(mark, at + 1)
            if at < 0:
                at = len(data)
            continue
        if bad is not None:
            yield "gap", {"file": name, "at": bad, "bytes": at - bad, "reason": why}
            bad = None
        yield "record", {"file": name, "at": at, "bytes": end - at, **row}
        at = end
    if bad is not None:
        yield "gap", {"file": name, "at": bad, "bytes": len(data) - bad, "reason": why}


def _bytes_of(uri: str):
    path = common.local_path(uri)
    if path:
        import mmap
        import os
        if not os.path.getsize(path):
            return b""
        with open(path, "rb") as f:
            return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    store, name = _open(uri)
    with store.open_input_file(name) as f:
        return f.read()


def _read(files: DataFrame, kind: str, schema: str) -> DataFrame:
    spark = files.sparkSession
    arrow = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    types = pa.schema([(f.split()[0], arrow[f.split()[1]]) for f in schema.split(", ")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, held = [], 0
                for what, row in salvage(_bytes_of(uri), uri):
                    if what == kind:
                        rows.append(row)
                        held += len(row.get("payload", b""))
                        if held > 4_000_000 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, types)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, types)

    return files.select("file").repartition(common.partitions_for(spark), "file").mapInArrow(task, schema)


def read(files: DataFrame) -> DataFrame:
    """Every record that can be recovered from the archives named in column ``file``."""
    return _read(files, "record", RECORD)


def gaps(files: DataFrame) -> DataFrame:
    """The quarantined byte ranges: file, at, bytes, reason (of the first failed check)."""
    return _read(files, "gap", GAP)


def page_of(uri):
    return F.regexp_extract(uri, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")
