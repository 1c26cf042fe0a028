"""Structured Streaming adapter.

The audited workflow has no streaming operators (no windows, watermarks or
state).  The only streaming need is to run the same detector on data as it
lands: :func:`scan_each_batch` applies :func:`splitsafe.operators.detector.scan`
to every micro-batch through ``foreachBatch`` and appends the five report rows,
tagged with the batch id, to a sink table.  Progress is kept in the
query's checkpoint location; a batch replayed after a failure appends its rows again
(at least once), so readers keep one set of rows per batch id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import detector
from ..roles import Roles


def scan_each_batch(stream: DataFrame, roles: Roles, sink_path: str, checkpoint: str,
                    fmt: str = "parquet", trigger_once: bool = False):
    """Start a streaming query that writes ``batch_id + report`` per micro-batch."""

    def audit(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()                                   # the detector reads it several times
        rep = detector.scan(batch, roles).select(F.lit(batch_id).cast("bigint").alias("batch_id"),
                                                 *detector.REPORT_COLUMNS)
        try:
            rep.write.mode("append").format(fmt).save(sink_path)
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(audit).option("checkpointLocation", checkpoint)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
