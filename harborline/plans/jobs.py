"""Load jobs: statistics upserts, backfill, master load, traffic summary.

Write path of a statistics load (one job, one commit-log row):
  0. the typed source rows are written once to the shared scratch folder
     (pages parsed once, however often the load reads the rows)
  1. months touched by the source (a short driver list, bounded by the window)
  2. read only the folders that the log names for those months, once: a filter
     of the source's keys splits the rows into those that may change and the
     others, written to the shared scratch folder
  3. upsert of the first part -> written to the scratch folder (lineage cut)
  4. months holding an insert or update are written to a folder of this load;
     months with nothing but keep/noop rows are not rewritten
  5. the commit-log row, which names the folder and its months, publishes the
     load at once. A load that stops before it leaves the table as it was, and
     running it again does all of it.
Scratch folders are removed when the job ends.
"""

from __future__ import annotations

import datetime as _dt
import logging
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions.casts import lenient, strict, strict_columns
from harborline.functions.dates import as_date, month_start
from harborline.operators import commitlog, merge, predicates
from harborline.schemas import DATASETS
from harborline.session import Staging
from harborline.sources import landing as landed
from harborline.sources import pages as pg
from harborline.sources import tables
from harborline.streaming import runner, running

log = logging.getLogger(__name__)

# Author of a load unless the caller names one, and table names as
# written into commit messages.
AUTHOR = "AIS ETL Pipeline"
TABLES = {"chokepoints": "portwatch.chokepoints", "ports": "portwatch.ports",
          "chokepoints_master": "portwatch.chokepoints_master",
          "ports_master": "portwatch.ports_master"}


def _table_path(root: str, table: str) -> str:
    return f"{root}/{table}"


def _stamp(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(as_of).cast("timestamp")


def _empty_table(spark: SparkSession, schema) -> DataFrame:
    df = spark.createDataFrame([], schema)
    return df.withColumn("created_at", F.lit(None).cast("timestamp")) \
             .withColumn("updated_at", F.lit(None).cast("timestamp"))


def read_stats(spark: SparkSession, root: str, kind: str, start=None, end=None, commit: str | None = None, time=None, ids=None) -> DataFrame:
    """The `kind` table ("chokepoints"/"ports") as committed, rows of
    [start, end] (either bound optional) and of `ids`, if given; as it was after `commit` or at
    `time`, if given."""
    months = commitlog.months_at(spark, f"{root}/_commits", TABLES[kind], commit, time)
    lo, hi = (as_date(d).replace(day=1) if d else None for d in (start, end))
    months = {m: load for m, load in months.items() if (lo is None or m >= lo) and (hi is None or m <= hi)}
    rows = tables.read_loads(spark, _table_path(root, kind), months, _stats_schema(kind))
    rows = predicates.apply(rows, predicates.ids(tables.ID, ids))
    if start:
        rows = rows.where(F.col("event_date") >= F.lit(as_date(start)))
    if end:
        rows = rows.where(F.col("event_date") <= F.lit(as_date(end)))
    return rows


def table_summary(spark: SparkSession, root: str, kind: str, author: str = AUTHOR) -> DataFrame:
    """Rows and date range of the whole table as committed, in the form of a
    commit-log row, from the footers of its files."""
    path = _table_path(root, kind)
    folders = tables.load_folders(path, commitlog.current_months(spark, f"{root}/_commits", TABLES[kind]))
    found = tables.date_bounds(spark, folders, path).first() if folders else (0, None, None)
    return commitlog.summary_of(*found, spark, TABLES[kind], author)


def commits(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """The commit-log rows of a table, oldest first."""
    return commitlog.read(spark, f"{root}/_commits").where(F.col("table") == TABLES[kind]).orderBy("snapshot")


def commit_changes(spark: SparkSession, root: str, kind: str, commit: str) -> DataFrame:
    """What a commit changed, as `merge.difference`: only the months that it
    replaced are read, as they were before it and after."""
    log_path, path = f"{root}/_commits", _table_path(root, kind)
    touched = commitlog.commit_months(spark, log_path, TABLES[kind], commit)
    earlier = commitlog.months_at(spark, log_path, TABLES[kind], before=commit)
    sides = [{m: load for m, load in earlier.items() if m in touched}, {m: commit for m in touched}]
    before, after = (tables.read_loads(spark, path, months, _stats_schema(kind)).drop(tables.MONTH) for months in sides)
    return merge.difference(before, after, merge.SPECS[kind].keys)


def remove_replaced(spark: SparkSession, root: str, kind: str, before) -> list[tuple]:
    """Delete the month folders that later commits had replaced by `before`;
    states since then can still be read. Returns (month, folder) of each."""
    gone = commitlog.replaced(spark, f"{root}/_commits", TABLES[kind], before)
    for month, load in gone:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_table_path(root, kind)}/load={load}/{tables.MONTH}={month}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def _stats_schema(kind: str):
    return DATASETS["daily_chokepoint" if kind == "chokepoints" else "daily_port"].table


def _counts(spark: SparkSession, merged: DataFrame) -> DataFrame:
    """The action counts, taken now (four rows at most): what they are counted
    from goes when the job ends."""
    counts = merge.action_counts(merged)
    return spark.createDataFrame(counts.collect(), counts.schema)


def load_stats(spark: SparkSession, source: DataFrame, root: str, kind: str,
               as_of=None, dry_run: bool = False, author: str = AUTHOR, cursor: int | None = None) -> DataFrame | None:
    """Upsert typed statistics rows into the `kind` table ("chokepoints"/"ports").
    `cursor` is kept in the commit-log row.

    Returns the per-action counts (also for a dry run, which writes nothing);
    None when the source is empty (nothing written, nothing logged)."""
    spec, log_path = merge.SPECS[kind], f"{root}/_commits"
    with Staging(spark) as stage:
        # rows without a date never reach a load (the date window drops them,
        # as in the extracts)
        source = stage(source.where(F.col("event_date").isNotNull()), "load-source")
        if source.isEmpty():
            log.warning("no rows to load into %s", kind)
            return None
        touched = {r[0] for r in source.select(month_start("event_date").alias("m")).distinct().collect()}
        months = commitlog.current_months(spark, log_path, TABLES[kind])
        target = tables.read_loads(spark, _table_path(root, kind), {m: v for m, v in months.items() if m in touched},
                                   _stats_schema(kind)).drop(tables.MONTH)
        # the target is read once, and split: rows that the source can't
        # match are not shuffled, and go from here to the load's folder
        split = stage(merge.split_target(target, source, spec), "load-target", by=["_may"])
        others = tables.with_month(split.where("NOT _may").drop("_may").withColumn("action", F.lit("keep")))
        merged = merge.upsert(split.where("_may"), source, spec, _stamp(as_of))
        if dry_run:
            return _counts(spark, tables.with_month(merged).unionByName(others))
        merged = stage(tables.with_month(merged), "load-merged")
        changed = [r[0] for r in merged.where(F.col("action").isin("insert", "update"))
                   .select(tables.MONTH).distinct().collect()]
        merged = merged.unionByName(others)
        snapshot = commitlog.new_snapshot() if changed else None
        if changed:
            tables.write_load(merged.where(F.col(tables.MONTH).isin(changed)).drop("action"), _table_path(root, kind), snapshot)
        commitlog.append(log_path, commitlog.summary(source, TABLES[kind], author), _stamp(as_of), snapshot, changed, cursor)
        return _counts(spark, merged)


def extract_chokepoints(pages: DataFrame, start, end, now=None,
                        meta: DataFrame | None = None) -> DataFrame:
    """Chokepoint rows of [start, end]: the relative window reaching back to
    `start` (plus one day), then the exact inclusive range."""
    now = as_date(now) if now is not None else _dt.datetime.now(_dt.timezone.utc).date()
    days = (now - as_date(start)).days + 1
    rows = pg.stat_scan(pages, "daily_chokepoint", days=days, now=now, meta=meta)
    rows = rows.where(predicates.between_days("event_date", start, end))
    return strict(rows, DATASETS["daily_chokepoint"].table)


def upsert_chokepoints(spark, pages: DataFrame, root: str, start=None, end=None,
                       now=None, as_of=None, dry_run=False, meta: DataFrame | None = None):
    """Chokepoint load over [start, end] (default: the 11-day window)."""
    if start is None or end is None:
        start, end = predicates.default_range(now)
    return load_stats(spark, extract_chokepoints(pages, start, end, now, meta), root,
                      "chokepoints", as_of, dry_run)


def backfill_ports(spark, sources: list[DataFrame], root: str, start=None, end=None,
                   now=None, as_of=None, dry_run=False):
    """All days of [start, end] in one load and one commit. `sources` are
    stat-row frames (e.g. one per feed or schema version), concatenated by
    column name; a column missing from one of them becomes null, one missing
    from all of them fails the load."""
    if start is None or end is None:
        start, end = predicates.default_range(now)
    table = DATASETS["daily_port"].table
    had = {c for s in sources for c in strict_columns(s, table)}
    rows = None
    for s in sources:
        own = strict(s, table, optional=tuple(had)).where(predicates.between_days("event_date", start, end))
        rows = own if rows is None else rows.unionByName(own)
    return load_stats(spark, rows, root, "ports", as_of, dry_run)


def _new_pages(spark, landing: str, stage: str, dataset: str, log_path: str, table: str):
    """What the landing has that the table's loads have not taken: pages and
    their cursor, (None, None) if there are none."""
    landed.ingest(spark, landing, stage, dataset)
    pages = landed.read_stage(spark, stage, dataset, after=commitlog.latest_cursor(spark, log_path, table))
    upto = landed.cursor(pages)
    if upto is None:
        log.warning("nothing new in %s", dataset)
        return None, None
    return pages.where(F.col(landed.INGEST) <= F.lit(upto)), upto


def load_new_chokepoints(spark, landing: str, stage: str, root: str, start=None, end=None,
                         now=None, as_of=None, dry_run=False):
    """Chokepoint load of what has come to the landing since the last one."""
    if start is None or end is None:
        start, end = predicates.default_range(now)
    pages, cursor = _new_pages(spark, landing, stage, "daily_chokepoint", f"{root}/_commits", TABLES["chokepoints"])
    if pages is None:
        return None
    return load_stats(spark, extract_chokepoints(pages, start, end, now), root, "chokepoints", as_of, dry_run, cursor=cursor)


def load_new_ports(spark, landing: str, stage: str, root: str, start=None, end=None,
                   now=None, as_of=None, dry_run=False):
    """Port load of what has come to the landing since the last one."""
    if start is None or end is None:
        start, end = predicates.default_range(now)
    pages, cursor = _new_pages(spark, landing, stage, "daily_port", f"{root}/_commits", TABLES["ports"])
    if pages is None:
        return None
    rows = strict(pg.stat_rows(pages).where(predicates.between_days("event_date", start, end)), DATASETS["daily_port"].table)
    return load_stats(spark, rows, root, "ports", as_of, dry_run, cursor=cursor)


def load_master(spark, pages: DataFrame, root: str, table: str, as_of=None,
                dry_run=False, null_key: str = "drop", author: str = AUTHOR) -> DataFrame | None:
    """Upsert master records into `table` (a snapshot table): every matched
    row is rewritten; the result becomes a new snapshot named in the log."""
    spec, log_path, path = merge.SPECS["master"], f"{root}/_commits", _table_path(root, table)
    with Staging(spark) as stage:
        source = stage(lenient(pg.master_rows(pages), DATASETS["ports_db"].table, null_key=null_key), "master-source")
        if source.isEmpty():
            log.warning("no master rows for %s", table)
            return None
        snap = commitlog.latest_snapshot(spark, log_path, TABLES[table])
        target = (spark.read.parquet(f"{path}/snapshot={snap}") if snap
                  else _empty_table(spark, DATASETS["ports_db"].table))
        merged = merge.upsert(target, source, spec, _stamp(as_of))
        if dry_run:
            return _counts(spark, merged)
        merged = stage(merged, "master-merged")
        snapshot = commitlog.new_snapshot()
        tables.write_snapshot(merged.drop("action"), path, snapshot)
        summary = source.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(author).alias("author"),
            F.format_string("Upsert %d rows into %s", F.col("row_count"), F.lit(TABLES[table])).alias("message"),
            F.lit(TABLES[table]).alias("table"), "row_count",
            F.lit(None).cast("date").alias("min_date"), F.lit(None).cast("date").alias("max_date"))
        commitlog.append(log_path, summary, _stamp(as_of), snapshot)
        return _counts(spark, merged)


def load_masters(spark, chokepoint_pages: DataFrame, port_pages: DataFrame, root: str,
                 as_of=None, dry_run=False) -> dict:
    """Both master tables, chokepoints first, then ports; each is its own
    load (and snapshot), not one atomic unit."""
    return {"chokepoints_master": load_master(spark, chokepoint_pages, root, "chokepoints_master",
                                              as_of, dry_run),
            "ports_master": load_master(spark, port_pages, root, "ports_master", as_of, dry_run)}


def register_views(spark, root: str, names: dict) -> list[str]:
    """Committed tables as temporary views: view name -> "ports",
    "chokepoints", "ports_master" or "chokepoints_master". `event_month` stays
    visible in the statistics views."""
    for view, table in names.items():
        frame = read_master(spark, root, table) if table.endswith("_master") else read_stats(spark, root, table)
        frame.createOrReplaceTempView(view)
    return list(names)


def read_master(spark, root: str, table: str) -> DataFrame:
    snap = commitlog.latest_snapshot(spark, f"{root}/_commits", TABLES[table])
    return spark.read.parquet(f"{_table_path(root, table)}/snapshot={snap}")


def traffic_summary(spark, landing: str | None, zones: DataFrame, sink_root: str,
                    duration_sec: int = 60, start=None, fmt: str = "parquet",
                    live: bool = False, **options) -> DataFrame:
    """Run the message stream for `duration_sec` (live) or over everything
    landed so far, then report total messages and distinct vessels. `options`
    go to the source (for Kafka: its servers and topics, with no landing)."""
    if fmt != "kafka":
        options = {"recursiveFileLookup": "true", **options}
    stream = runner.read_messages(spark, landing, fmt, **options)
    flow = runner.traffic(stream, zones, start, duration_sec if start is not None else None)
    query = runner.start_sink(flow, sink_root, available_now=not live,
                              processing_time="5 seconds" if live else None)
    runner.run_for(query, duration_sec if live else None)
    return runner.traffic_summary(spark, sink_root)


def traffic_running(spark, landing: str | None, zones: DataFrame, sink_root: str, duration_sec: int | None = None,
                    fmt: str = "parquet", window: str = "1 minute", late: str = "1 minute", **options) -> DataFrame:
    """The message stream with running figures: distinct vessels and messages
    by window, as streaming state beside the message sink. Runs for
    `duration_sec`, all three queries at a time, or over everything landed so
    far; a later call with the same `sink_root` goes on where this one ended.
    Returns the totals as of the end (`running.totals`)."""
    if fmt != "kafka":
        options = {"recursiveFileLookup": "true", **options}

    how = {"available_now": duration_sec is None, "processing_time": None if duration_sec is None else "5 seconds"}

    def followers(**how):
        yield running.start(running.ships(running.follow_sink(spark, sink_root)), sink_root, "ships", **how)
        yield running.start(running.counts(running.follow_sink(spark, sink_root), window, late), sink_root, "counts", **how)

    flow = runner.traffic(runner.read_messages(spark, landing, fmt, **options), zones)
    deadline = None if duration_sec is None else time.monotonic() + duration_sec
    query = runner.start_sink(flow, sink_root, **how)
    if duration_sec is None:
        running.run_all([query])
    else:
        # the sink can be followed once it has committed its first files
        while query.isActive and time.monotonic() < deadline and not running.sink_has_files(spark, sink_root):
            query.awaitTermination(0.2)
        live = list(followers(**how)) if running.sink_has_files(spark, sink_root) else []
        running.run_all([query, *live], deadline - time.monotonic())
    if running.sink_has_files(spark, sink_root):
        running.run_all(list(followers()))  # what the sink has committed last
    return running.totals(spark, sink_root)
