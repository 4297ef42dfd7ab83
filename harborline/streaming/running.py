"""Figures of a live run while it runs, kept as streaming state.

Two queries follow the message sink (`runner.start_sink`), so a message is
parsed and matched once, whatever is counted from it; they read the files that
the sink has committed, each once.

* Ships: `dropDuplicates` on the vessel id appends each vessel to the `ships`
  sink when it is first seen. The state is one key a vessel (some 10^5 to 10^6
  in the world, whatever the number of messages); the exact number of distinct
  vessels so far is the number of rows of the sink, known from file footers.
* Counts: messages by window of arrival time, appended to the `counts` sink
  when the watermark (the latest arrival less `late`) has passed a window's
  end, and then dropped from the state, which holds `late` worth of windows.
  The sum over the sink is the number of messages up to the last closed window.

Each query has its checkpoint beside its sink: started again after a stop or a
failure, it goes on with the files that it has not counted. On a cluster the
state store is RocksDB (`session.CLUSTER_CONF`), so state need not fit in the
heap; the number of shuffle partitions is fixed at the first start.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

SINK_SCHEMA = ("received timestamp_ntz, parsed_ok boolean, message_type string, mmsi bigint, ship_name string, latitude double, "
               "longitude double, destination string, ship_id string, kind string")
SHIPS = "ship_id string"
EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
COUNTS = "window_start timestamp_ntz, window_end timestamp_ntz, n_messages bigint"


def follow_sink(spark: SparkSession, sink_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The messages that the sink has committed, as a stream."""
    r = spark.readStream.schema(SINK_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(f"{sink_root}/messages")


def sink_has_files(spark: SparkSession, sink_root: str) -> bool:
    """Whether the message sink has committed anything yet."""
    log = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sink_root}/messages/_spark_metadata")
    return log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(log)


def ships(msgs: DataFrame) -> DataFrame:
    """Each vessel once, when it is first seen."""
    return msgs.select("ship_id").dropDuplicates(["ship_id"])


def counts(msgs: DataFrame, window: str = "1 minute", late: str = "1 minute") -> DataFrame:
    """Messages by window of arrival time. `late`: how far a message may come
    behind the latest one and still be counted. (A watermark needs instants,
    so arrivals are taken as UTC and the windows given back without a zone.)"""
    instant = F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {EPOCH}, received))").alias("received")
    by = msgs.select(instant).withWatermark("received", late).groupBy(F.window("received", window).alias("w"))
    plain = lambda c: F.expr(f"{EPOCH} + make_dt_interval(0, 0, 0, CAST(unix_micros({c}) / 1000000BD AS DECIMAL(18, 6)))")
    return by.agg(F.count(F.lit(1)).alias("n_messages")).select(
        plain("w.start").alias("window_start"), plain("w.end").alias("window_end"), "n_messages")


def start(stream: DataFrame, sink_root: str, name: str, available_now: bool = True, processing_time: str | None = None):
    """Start the append sink `name` with its checkpoint."""
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", f"{sink_root}/{name}").option("checkpointLocation", f"{sink_root}/_checkpoints/{name}"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def run_all(queries: list, seconds: float | None = None, step: float = 0.2) -> None:
    """Wait until all queries have finished, or `seconds` have passed, then
    stop them. The first failure of any is raised here, and stops the others."""
    deadline = None if seconds is None else time.monotonic() + seconds
    try:
        while any(q.isActive for q in queries) and (deadline is None or time.monotonic() < deadline):
            for q in queries:
                q.awaitTermination(step)
        for q in queries:
            if not q.isActive:
                q.awaitTermination()
    finally:
        for q in queries:
            q.stop()


def _sink(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A sink's rows; none if it has not been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_ships(spark: SparkSession, sink_root: str) -> DataFrame:
    return _sink(spark, f"{sink_root}/ships", SHIPS)


def read_counts(spark: SparkSession, sink_root: str) -> DataFrame:
    """Closed windows with `running_messages`, the messages up to the end of
    each. One row a window, whatever the number of messages."""
    upto = Window.orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    return _sink(spark, f"{sink_root}/counts", COUNTS).withColumn("running_messages", F.sum("n_messages").over(upto))


def totals(spark: SparkSession, sink_root: str) -> DataFrame:
    """One row: `counted_until` (end of the last closed window, null before
    the first), `total_messages` up to it, and `unique_ships` so far."""
    closed = _sink(spark, f"{sink_root}/counts", COUNTS).agg(
        F.max("window_end").alias("counted_until"), F.coalesce(F.sum("n_messages"), F.lit(0)).alias("total_messages"))
    seen = read_ships(spark, sink_root).agg(F.count(F.lit(1)).alias("unique_ships")).first()["unique_ships"]
    return closed.withColumn("unique_ships", F.lit(seen).cast("bigint"))


def state_size(query) -> dict:
    """Rows and bytes of a query's state after its last trigger."""
    progress = query.lastProgress
    operators = progress["stateOperators"] if progress else []
    rows, size = sum(o["numRowsTotal"] for o in operators), sum(o["memoryUsedBytes"] for o in operators)
    return {"rows": rows, "bytes": size}
