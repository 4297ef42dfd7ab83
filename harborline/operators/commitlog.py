"""Commit log of table loads: one row per load, and what makes it visible.

A load writes its data to a folder of its own, then appends its row: author,
message `Upsert {n} rows into {table} (Range: {min} to {max})`, table, row
count and date range of the loaded set, time, `snapshot` (the folder) and
`months` (those that the folder replaces; null for a whole table), `cursor` (the
latest ingest that the load took, of one from a staged landing). Readers take
from the log which folders count, so a load that stopped before its row left
nothing to be seen, and the row is one file that appears at once.

The log itself stays short: after `COMPACT_AFTER` files they are gathered into
one (`compact`), with the name of the file that each row came from. That file
appears at once; the gathered ones are deleted after it, and until they are,
readers leave out those it names, so a stop in between counts no row twice.

Every state of a table that has not been removed can be read again: the log's
rows up to a commit, or up to a time, name the folders that held its months
then (`months_at`).

Snapshots sort by the time they were written, whatever `committed_at` the
caller gives; one writer at a time is assumed for a table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from harborline.functions.text import commit_message
from harborline.schemas import COMMIT_LOG


def summary(source: DataFrame, table: str, author: str, date_col: str = "event_date") -> DataFrame:
    """Row count and date range of a loaded set, in one aggregation pass."""
    agg = source.agg(F.count(F.lit(1)).alias("row_count"),
                     F.min(date_col).alias("min_date"),
                     F.max(date_col).alias("max_date"))
    return _described(agg, table, author)


def _described(agg: DataFrame, table: str, author: str) -> DataFrame:
    return agg.select(
        F.lit(author).alias("author"),
        commit_message(table, F.col("row_count"), F.col("min_date"), F.col("max_date")).alias("message"),
        F.lit(table).alias("table"), "row_count", "min_date", "max_date")


def summary_of(row_count: int, min_date, max_date, spark: SparkSession, table: str, author: str) -> DataFrame:
    """`summary` of a set whose figures are known."""
    agg = spark.createDataFrame([(row_count, min_date, max_date)], "row_count long, min_date date, max_date date")
    return _described(agg, table, author)


def new_snapshot() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")


def append(log_path: str, summary_df: DataFrame, committed_at: Column | None = None,
           snapshot: str | None = None, months: list | None = None, cursor: int | None = None) -> None:
    committed_at = F.current_timestamp() if committed_at is None else committed_at
    listed = F.lit(None) if months is None else F.array(*[F.lit(m) for m in months])
    row = summary_df.select(*[c for c in summary_df.columns],
                            committed_at.cast("timestamp").alias("committed_at"),
                            F.lit(snapshot).cast("string").alias("snapshot"),
                            listed.cast("array<date>").alias("months"),
                            F.lit(cursor).cast("bigint").alias("cursor"))
    row.select(*[f.name for f in COMMIT_LOG.fields]).coalesce(1) \
        .write.mode("append").parquet(log_path)
    if len(_files(row.sparkSession, log_path)) >= COMPACT_AFTER:
        compact(row.sparkSession, log_path)


#: Log files that make a load compact the log.
COMPACT_AFTER = 64
# hidden from readers of the log's folder, as its name starts with _
GATHERED, FILE = "_gathered", "_file"


def _listed(spark: SparkSession, path: str) -> list:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath() for s in fs.listStatus(p)] if fs.exists(p) else []


def _files(spark: SparkSession, log_path: str) -> list:
    return [p for p in _listed(spark, log_path) if p.getName().endswith(".parquet")]


def _gathered(spark: SparkSession, log_path: str) -> str | None:
    """The newest whole gathering."""
    whole = [p for p in _listed(spark, f"{log_path}/{GATHERED}") if any(f.getName() == "_SUCCESS" for f in _listed(spark, p.toString()))]
    return max((p.toString() for p in whole), default=None)


def _with_files(spark: SparkSession, log_path: str) -> DataFrame:
    rows = spark.read.schema(COMMIT_LOG).parquet(log_path).select("*", F.col("_metadata.file_name").alias(FILE))
    path = _gathered(spark, log_path)
    if path is None:
        return rows
    kept = spark.read.schema(rows.schema).parquet(path)
    return kept.unionByName(rows.join(kept.select(FILE).distinct(), FILE, "left_anti"))


def read(spark: SparkSession, log_path: str) -> DataFrame:
    return _with_files(spark, log_path).drop(FILE)


def compact(spark: SparkSession, log_path: str) -> None:
    """Gather the log's files into one; the rows stay the same. One compaction
    of a log at a time (loads of other tables may go on)."""
    files, before = _files(spark, log_path), _gathered(spark, log_path)
    _with_files(spark, log_path).coalesce(1).write.parquet(f"{log_path}/{GATHERED}/{new_snapshot()}")
    for path in [*files, *(p for p in _listed(spark, f"{log_path}/{GATHERED}") if p.toString() == before)]:
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _committed(spark: SparkSession, log_path: str, table: str) -> DataFrame | None:
    rows = _rows(spark, log_path, table)
    return None if rows is None else rows.where(F.col("snapshot").isNotNull())


def _rows(spark: SparkSession, log_path: str, table: str) -> DataFrame | None:
    try:
        return read(spark, log_path).where(F.col("table") == table)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # nothing has been committed yet


def latest_snapshot(spark: SparkSession, log_path: str, table: str) -> str | None:
    """The newest committed folder of a whole-table load."""
    rows = _committed(spark, log_path, table)
    return None if rows is None else rows.agg(F.max("snapshot").alias("s")).first()["s"]


def latest_cursor(spark: SparkSession, log_path: str, table: str) -> int | None:
    """The latest ingest that the table's loads have taken."""
    rows = _rows(spark, log_path, table)
    return None if rows is None else rows.agg(F.max("cursor").alias("c")).first()["c"]


def current_months(spark: SparkSession, log_path: str, table: str) -> dict:
    """{month: the newest committed folder that holds it}; one entry for each
    month that the table has."""
    return months_at(spark, log_path, table)


def months_at(spark: SparkSession, log_path: str, table: str, commit: str | None = None, time=None, before: str | None = None) -> dict:
    """{month: folder} as it was after `commit` (a snapshot's name), before
    the commit `before`, or at `time` (by `committed_at`); now if none is
    given. A commit that the table does not have is an error."""
    rows = _committed(spark, log_path, table)
    for c in (commit, before):
        if c is not None and (rows is None or rows.where(F.col("snapshot") == c).isEmpty()):
            raise ValueError(f"{table} has no commit {c}")
    if rows is None:
        return {}
    if commit is not None:
        rows = rows.where(F.col("snapshot") <= commit)
    if before is not None:
        rows = rows.where(F.col("snapshot") < before)
    if time is not None:
        rows = rows.where(F.col("committed_at") <= F.lit(time).cast("timestamp"))
    months = rows.select("snapshot", F.explode("months").alias("month")).groupBy("month").agg(F.max("snapshot").alias("s"))
    return {r["month"]: r["s"] for r in months.collect()}


def commit_months(spark: SparkSession, log_path: str, table: str, commit: str) -> list:
    """The months that a commit replaced."""
    rows = _committed(spark, log_path, table)
    found = None if rows is None else rows.where(F.col("snapshot") == commit).select("months").first()
    if found is None:
        raise ValueError(f"{table} has no commit {commit}")
    return list(found["months"] or [])


def replaced(spark: SparkSession, log_path: str, table: str, before) -> list[tuple]:
    """(month, folder) that no state since `before` (by `committed_at`) reads."""
    rows = _committed(spark, log_path, table)
    if rows is None:
        return []
    pairs = rows.select("snapshot", (F.col("committed_at") > F.lit(before).cast("timestamp")).alias("recent"), F.explode("months").alias("month"))
    kept = set(months_at(spark, log_path, table, time=before).items()) | set(months_at(spark, log_path, table).items())
    return sorted((r["month"], r["snapshot"]) for r in pairs.where("NOT recent").collect() if (r["month"], r["snapshot"]) not in kept)
