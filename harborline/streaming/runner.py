"""Running the message stream with Structured Streaming.

The stream is stateless: parse -> valid id -> zone filter -> duration cut,
then one append-only Parquet sink partitioned by the kind of message, with its
checkpoint next to it (a shared folder on a cluster), so a restarted query
resumes exactly where it stopped, and each line is read, parsed and matched
once. Positions and statics are folders of that sink (`read_sink`). Totals are
a batch aggregate over it (`messages.summary`), which is exact and needs no
unbounded per-vessel state in the stream.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.operators.spatial import in_any_zone
from harborline.streaming import messages as M

LANDING_SCHEMA = "received timestamp_ntz, value string"


def read_messages(spark: SparkSession, path: str | None, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Streaming source of (received, value).

    fmt = "parquet" / "json": landing files with both columns;
    fmt = "text": raw message lines, arrival = the file's modification time;
    fmt = "kafka": pass the Kafka options; arrival = the record timestamp."""
    r = spark.readStream.format(fmt)
    if fmt in ("parquet", "json"):
        r = r.schema(LANDING_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load(path) if path else r.load()
    if fmt == "kafka":
        df = df.selectExpr("CAST(timestamp AS TIMESTAMP_NTZ) AS received",
                           "CAST(value AS STRING) AS value")
    elif fmt == "text":
        df = df.selectExpr("CAST(_metadata.file_modification_time AS TIMESTAMP_NTZ) AS received",
                           "value")
    return df


def traffic(stream: DataFrame, zones: DataFrame, start=None, duration_sec: int | None = None) -> DataFrame:
    msgs = M.valid_ship(M.parse(stream))
    msgs = in_any_zone(msgs, zones)
    if start is not None and duration_sec is not None:
        msgs = M.within_duration(msgs, start, duration_sec)
    return msgs


def start_sink(msgs: DataFrame, sink_root: str, available_now: bool = True,
               processing_time: str | None = None):
    """Start the append sink; returns the streaming query."""
    w = (msgs.withColumn("kind", M.kind(msgs)).writeStream.format("parquet").outputMode("append")
         .partitionBy("kind")
         .option("path", f"{sink_root}/messages")
         .option("checkpointLocation", f"{sink_root}/_checkpoints/messages"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def run_for(query, seconds: float | None = None) -> None:
    """Wait until the query finishes (availableNow) or `seconds` have passed,
    then stop it. A failure of the query is raised here."""
    if seconds is None:
        query.awaitTermination()
        return
    deadline = time.monotonic() + seconds
    try:
        query.awaitTermination(max(0.0, deadline - time.monotonic()))
    finally:
        query.stop()


def run_batches(query, n: int, step: float = 0.05) -> None:
    """Wait until `n` micro-batches are done (or the query ends), then stop
    it; the checkpoint keeps what they did. A failure is raised here."""
    try:
        while query.isActive and (query.lastProgress is None or query.lastProgress["batchId"] + 1 < n):
            query.awaitTermination(step)
        if not query.isActive:
            query.awaitTermination()
    finally:
        query.stop()


def read_sink(spark: SparkSession, sink_root: str, what: str = "messages") -> DataFrame:
    """All messages of a sink, or its 'positions' or 'statics' (only their
    folder is read)."""
    msgs = spark.read.parquet(f"{sink_root}/messages")
    if what == "positions":
        return M.positions(msgs.where(F.col("kind") == "position"))
    if what == "statics":
        return M.statics(msgs.where(F.col("kind") == "static"))
    return msgs


def traffic_summary(spark: SparkSession, sink_root: str) -> DataFrame:
    return M.summary(read_sink(spark, sink_root))
