"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (whole tables) and runs the library's
operators over data Spark derives from them (see plans.fixtures). The DuckDB
text of each query is in plans.oracles under the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.functions.casts import lenient, strict
from harborline.functions.dates import calendar, event_date
from harborline.operators import commitlog, merge, paging, predicates
from harborline.operators.spatial import in_any_zone, tag_zones
from harborline.plans import fixtures as fx
from harborline.schemas import CHOKEPOINTS, MASTER, PORTS
from harborline.session import materialize, scratch_path
from harborline.sources import landing, ordered
from harborline.sources import pages as pg
from harborline.sources import tables
from harborline.sources.zones import zones_frame
from harborline.streaming import messages as M
from harborline.streaming import runner, running

TARGET_BEFORE = "2024-01-21 00:00:00"   # prior load saw events before this
SOURCE_FROM = "2024-01-15 00:00:00"     # this load re-reads events from here
PAGE_SIZE = 100
STREAM_START = "2024-01-01 00:00:00"
STREAM_SECONDS = 20 * 86400
# stored columns of the order-derived statistics table (a chokepoint-like subset)
UNUSED = ("n_general_cargo", "n_roro", "n_cargo")
CHOKEPOINTS_LIKE = T.StructType([f for f in CHOKEPOINTS.fields if f.name not in UNUSED])


def _events(spark, sf):
    return fx.read(spark, sf, "events")


def _chk_pair(spark, sf):
    ev = _events(spark, sf)
    target = fx.with_audit(fx.chokepoint_stats(
        ev.where(F.col("ts") < fx.ts_ntz(TARGET_BEFORE)), fx.shifted_day(ev)))
    source = fx.chokepoint_stats(ev.where(F.col("ts") >= fx.ts_ntz(SOURCE_FROM)), fx.utc_day(ev))
    return target, source


def _port_pair(spark, sf):
    ev = _events(spark, sf)
    target = fx.with_audit(fx.port_stats(
        ev.where(F.col("ts") < fx.ts_ntz(TARGET_BEFORE)), fx.shifted_day(ev)))
    source = fx.port_stats(ev.where(F.col("ts") >= fx.ts_ntz(SOURCE_FROM)), fx.utc_day(ev))
    return target, source


def _port_stats(spark, sf):
    ev = _events(spark, sf)
    return fx.port_stats(ev, fx.utc_day(ev))


def _chk_stats(spark, sf):
    ev = _events(spark, sf)
    return fx.chokepoint_stats(ev, fx.utc_day(ev))


# --------------------------------------------------------------------- upserts
def upsert_chokepoints(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _chk_pair(spark, sf)
    return merge.upsert(target, source, merge.SPECS["chokepoints"], fx.ts_ntz(fx.AS_OF))


def upsert_ports(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _port_pair(spark, sf)
    return merge.upsert(target, source, merge.SPECS["ports"], fx.ts_ntz(fx.AS_OF))


def _master(spark, sf):
    return fx.master_attributes(spark, sf)


def upsert_master(spark: SparkSession, sf: str) -> DataFrame:
    m = _master(spark, sf)
    target = fx.with_audit(lenient(m.where(F.col("s_nationkey") < 15), MASTER))
    source = lenient(m.where(F.col("s_nationkey") >= 10), MASTER)
    return merge.upsert(target, source, merge.SPECS["master"], fx.ts_ntz(fx.AS_OF))


def upsert_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Default (duplicate-safe) upsert on a source with real duplicate keys:
    one row per order keyed by (customer, order day) -- a customer ordering
    twice on a day repeats the key. The table holds the daily statistics
    before 1995; the source starts in 1995, so no duplicated key matches and
    every source row, duplicates included, is inserted."""
    o = fx.read(spark, sf, "orders")
    target = fx.with_audit(strict(_order_stats(spark, sf)
                                  .where(F.col("event_date") < F.lit("1995-01-01").cast("date")),
                                  CHOKEPOINTS, optional=UNUSED))
    st = F.col("o_orderstatus")
    rows = o.where(F.col("o_orderdate") >= fx.ts_ntz("1995-01-01 00:00:00")).select(
        F.col("o_custkey").cast("string").alias("portid"),
        F.concat(F.lit("Chokepoint "), F.col("o_custkey")).alias("portname"),
        (st == "F").cast("int").alias("n_tanker"), (st == "O").cast("int").alias("n_container"),
        (st == "P").cast("int").alias("n_dry_bulk"), F.lit(1).alias("n_total"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("capacity"),
        F.to_date("o_orderdate").alias("event_date"))
    return merge.upsert(target, strict(rows, CHOKEPOINTS, optional=UNUSED), merge.SPECS["chokepoints"],
                        fx.ts_ntz(fx.AS_OF))


def upsert_narrow(spark: SparkSession, sf: str) -> DataFrame:
    """A table of all days, and a source of a few: corrected counts of 1997-06
    and new days of ports 1 to 50. Most target rows are read and passed on."""
    stats = strict(_order_stats(spark, sf), CHOKEPOINTS, optional=UNUSED)
    june = F.trunc("event_date", "month") == F.lit("1997-06-01").cast("date")
    fixed = stats.where(june).withColumn("capacity", F.col("capacity") + F.col("n_total") % 2)
    fresh = stats.where("CAST(portid AS INT) <= 50").withColumn("event_date", F.add_months("event_date", 120))
    return merge.upsert_narrow(fx.with_audit(stats), fixed.unionByName(fresh), merge.SPECS["chokepoints"], fx.ts_ntz(fx.AS_OF))


def upsert_dry_run(spark: SparkSession, sf: str) -> DataFrame:
    return merge.action_counts(upsert_chokepoints(spark, sf))


def _backfill_feeds(ev: DataFrame):
    """Two daily port feeds, 2024-01-10..17 and 2024-01-18..25; the later one
    lacks `export_roro` (an older schema of the service)."""
    day = fx.utc_day(ev)
    early = fx.port_stats(ev.where(predicates.between_days(day, "2024-01-10", "2024-01-17")), day)
    late = fx.port_stats(ev.where(predicates.between_days(day, "2024-01-18", "2024-01-25")), day)
    return early, late.drop("export_roro")


def backfill_ports(spark: SparkSession, sf: str) -> DataFrame:
    """Backfill 2024-01-10..2024-01-25 as one load: the day range is one
    pushed-down predicate; two feeds (the later one without `export_roro`)
    are concatenated by name, missing columns as null."""
    ev = _events(spark, sf)
    target = fx.with_audit(fx.port_stats(
        ev.where(F.col("ts") < fx.ts_ntz(TARGET_BEFORE)), fx.shifted_day(ev)))
    early, late = _backfill_feeds(ev)
    source = strict(early.unionByName(late, allowMissingColumns=True), PORTS)
    # the union is read by four branches of the duplicate-safe upsert (count,
    # semi, anti, probe): compute it once into the shared scratch folder
    source = materialize(source, "backfill-source")
    return merge.upsert(target, source, merge.SPECS["ports"], fx.ts_ntz(fx.AS_OF))


def backfill_job(spark: SparkSession, sf: str) -> DataFrame:
    """The load job end to end on a fresh table root: an initial load (the
    prior rows, all inserts), then the two-feed backfill as one load (month
    partitions read, merged and staged, changed months overwritten, commit
    log appended); returns the table as stored afterwards."""
    from harborline.plans import jobs

    root = scratch_path(spark, "backfill_job")
    ev = _events(spark, sf)
    prior = fx.port_stats(ev.where(F.col("ts") < fx.ts_ntz(TARGET_BEFORE)), fx.shifted_day(ev))
    jobs.load_stats(spark, prior, root, "ports", as_of=fx.ts_ntz(fx.PRIOR_LOAD))
    early, late = _backfill_feeds(ev)
    jobs.backfill_ports(spark, [early, late], root, "2024-01-10", "2024-01-25",
                        as_of=fx.ts_ntz(fx.AS_OF))
    stored = jobs.read_stats(spark, root, "ports").drop(tables.MONTH)
    return (stored.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
            .withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz")))


# ----------------------------------------------------------------- projections
def project_chokepoints(spark: SparkSession, sf: str) -> DataFrame:
    raw = fx.raw_attributes(_chk_stats(spark, sf))
    rows = raw.withColumn("event_date", event_date("date")).drop("date")
    return strict(rows, CHOKEPOINTS)


def project_ports(spark: SparkSession, sf: str) -> DataFrame:
    raw = fx.raw_attributes(_port_stats(spark, sf))
    rows = raw.withColumn("event_date", event_date("date")).drop("date")
    return strict(rows, PORTS)


def project_master(spark: SparkSession, sf: str) -> DataFrame:
    return lenient(_master(spark, sf), MASTER)


def master_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Master pages (50 records a page) -> stop rule -> nameless rows dropped
    -> lenient casts -> ordered by name, then id."""
    path = fx.landed_master_log_path(spark, sf, 50)  # some records have no name
    return lenient(pg.master_rows(landing.read_log_once(spark, path, "ports_db")), MASTER).orderBy("portname", "portid")


def epoch_to_date(spark: SparkSession, sf: str) -> DataFrame:
    ev = _events(spark, sf)
    r = F.col("event_id") % 20
    raw = (F.when(r == 0, F.lit(None).cast("string"))
           .when(r == 1, F.lit("0"))
           .when(r == 2, F.to_date("ts").cast("string"))
           .otherwise(fx.epoch_millis_utc("ts").cast("string")))
    return ev.select("event_id", event_date(raw).alias("event_date"))


def _order_stats(spark, sf):
    o = fx.read(spark, sf, "orders")
    st = F.col("o_orderstatus")
    return (o.groupBy(F.col("o_custkey"), F.to_date("o_orderdate").alias("event_date"))
            .agg(F.count_if(st == "F").cast("int").alias("n_tanker"),
                 F.count_if(st == "O").cast("int").alias("n_container"),
                 F.count_if(st == "P").cast("int").alias("n_dry_bulk"),
                 F.count(F.lit(1)).cast("int").alias("n_total"),
                 F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("capacity"))
            .select(F.col("o_custkey").cast("string").alias("portid"),
                    F.concat(F.lit("Chokepoint "), F.col("o_custkey")).alias("portname"),
                    "n_tanker", "n_container", "n_dry_bulk", "n_total", "capacity", "event_date"))


def month_partition(spark: SparkSession, sf: str) -> DataFrame:
    s = tables.with_month(_order_stats(spark, sf))
    return s.groupBy(tables.MONTH).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n_total").cast("bigint").alias("n_total"),
        F.min("event_date").alias("first_day"), F.max("event_date").alias("last_day"))


# ------------------------------------------------------------------ predicates
def filter_range(spark: SparkSession, sf: str) -> DataFrame:
    return _port_stats(spark, sf).where(
        predicates.date_range("event_date", now=fx.NOW, start="2024-01-10", end="2024-01-20"))


def filter_since(spark: SparkSession, sf: str) -> DataFrame:
    return _port_stats(spark, sf).where(
        predicates.date_range("event_date", now=fx.NOW, start="2024-01-25", end=None))


def filter_days(spark: SparkSession, sf: str) -> DataFrame:
    return _port_stats(spark, sf).where(predicates.date_range("event_date", now=fx.NOW, days=7))


def filter_day(spark: SparkSession, sf: str) -> DataFrame:
    return _port_stats(spark, sf).where(predicates.on_day("event_date", "2024-01-15"))


def filter_ids(spark: SparkSession, sf: str) -> DataFrame:
    names = ["Chokepoint 3", "Chokepoint 17", "Chokepoint 42", "O'Brien Passage"]
    return predicates.apply(_chk_stats(spark, sf), predicates.ids("portname", names))


def chokepoint_recent(spark: SparkSession, sf: str) -> DataFrame:
    """Chokepoint load extract for 2024-01-05..2024-01-20 on 2024-01-31: an
    over-wide relative window (days back to the start, plus one), then the
    exact inclusive range as a residual filter."""
    start, end = "2024-01-05", "2024-01-20"
    days = (predicates.as_date(fx.NOW) - predicates.as_date(start)).days + 1
    rows = _chk_stats(spark, sf).where(predicates.date_range("event_date", now=fx.NOW, days=days))
    return rows.where(predicates.between_days("event_date", start, end))


def port_range(spark: SparkSession, sf: str) -> DataFrame:
    return predicates.apply(
        _port_stats(spark, sf),
        predicates.date_range("event_date", now=fx.NOW, start="2024-01-08", end="2024-01-12"),
        predicates.ids("portid", ["1", "2", "3", "10", "100"]))


def day_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Rows loaded per day of a backfill range, days without data as 0."""
    days = calendar(spark, "2023-12-30", "2024-02-02")
    per_day = _port_stats(spark, sf).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))
    return (days.join(per_day, "event_date", "left")
            .select("event_date", F.coalesce("n", F.lit(0)).alias("n_rows")))


# ---------------------------------------------------------------------- pages
def _event_rows(spark, sf, inject_stops, on_error):
    path = fx.landed_pages_path(spark, sf, PAGE_SIZE, inject_stops)
    return pg.stat_rows(landing.read_log_once(spark, path, "daily_chokepoint"), on_error)


def _stat_columns(df):
    return strict(df, CHOKEPOINTS).select(
        "portid", "portname", *[F.col(f.name).cast("bigint") for f in CHOKEPOINTS.fields if f.name.startswith("n_")],
        "capacity", "event_date")


def stat_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _stat_columns(_event_rows(spark, sf, False, on_error="fail"))


def page_stop(spark: SparkSession, sf: str) -> DataFrame:
    return _stat_columns(_event_rows(spark, sf, True, on_error="keep"))


def page_slice(spark: SparkSession, sf: str) -> DataFrame:
    s = _port_stats(spark, sf).select("portid", "event_date")
    return paging.number_rows(s, [F.asc("portid"), F.desc("event_date")], size=1000)


def stat_order(spark: SparkSession, sf: str) -> DataFrame:
    return _port_stats(spark, sf).select("portid", "event_date", "portcalls") \
        .orderBy(F.asc("portid"), F.desc("event_date"))


def page_corrupt(spark: SparkSession, sf: str) -> DataFrame:
    """Page 2 of each day is cut off in the page log: kept are the pages before."""
    path = fx.landed_pages_path(spark, sf, PAGE_SIZE, False, cut_page=2)
    return _stat_columns(pg.stat_rows(landing.read_log_once(spark, path, "daily_chokepoint"), "keep"))


def stat_scan_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Counts that arrive as numbers, text, floats or null."""
    path = fx.landed_pages_path(spark, sf, PAGE_SIZE, False, mixed=True)
    return _stat_columns(pg.stat_rows(landing.read_log_once(spark, path, "daily_chokepoint")))


def chokepoint_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The chokepoint scan from stored pages, by names and range."""
    path = fx.landed_pages_path(spark, sf, PAGE_SIZE, False)
    return _stat_columns(pg.stat_scan(landing.read_log_once(spark, path, "daily_chokepoint"), "daily_chokepoint",
                                      ids=["Chokepoint 3", "Chokepoint 17", "Chokepoint 42"],
                                      start="2024-01-05", end="2024-01-20", now=fx.NOW))


def chokepoint_job(spark: SparkSession, sf: str) -> DataFrame:
    """The chokepoint load from stored pages into a new table, then read back
    as committed. (The fixture has a record for each event, so keys repeat and
    all rows of the range are inserted.)"""
    from harborline.plans import jobs

    path, root = fx.landed_pages_path(spark, sf, PAGE_SIZE, False), scratch_path(spark, "chokepoint_job")
    jobs.upsert_chokepoints(spark, landing.read_log_once(spark, path, "daily_chokepoint"), root, "2024-01-05", "2024-01-20",
                            now=fx.NOW, as_of=fx.ts_ntz(fx.AS_OF))
    stored = jobs.read_stats(spark, root, "chokepoints").drop(tables.MONTH)
    return (stored.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
            .withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz")))


def page_one(spark: SparkSession, sf: str) -> DataFrame:
    """Rows 1000 to 1099 of the port statistics in order, of a table without
    an order index."""
    s = _port_stats(spark, sf).select("portid", "event_date")
    return paging.page(s, [F.asc("portid"), F.desc("event_date")], 1000, 100)


def page_seek(spark: SparkSession, sf: str) -> DataFrame:
    """The same page by seek, from a table stored in the order."""
    path = scratch_path(spark, "ordered")
    ordered.write_ordered(_port_stats(spark, sf), path, [("portid", True), ("event_date", False)])
    return ordered.read_page(spark, path, 1000, 100).select("portid", "event_date")


def stats_by_id(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of five ids in 1995 and 1996, of months clustered by id."""
    rows = tables.read_stats(spark, _stats_table(spark, sf), "1995-01-01", "1996-12-31", ids=["1", "2", "77", "500", "1499"])
    return rows.drop(tables.MONTH)


def commit_range(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and date range of a table after its loads, from file footers."""
    from harborline.plans import jobs

    root, _ = _three_loads(spark, sf)
    return jobs.table_summary(spark, root, "ports")


def upsert_hot_target(spark: SparkSession, sf: str) -> DataFrame:
    """A target that holds keys several times (a row for each order, as an
    earlier load inserted them) and equal rows without a key, on both sides."""
    o = fx.read(spark, sf, "orders")
    day, hidden = F.to_date("o_orderdate"), F.col("o_custkey") % 10 == 0
    rows = o.select(
        F.when(~hidden, F.col("o_custkey").cast("string")).alias("portid"), F.lit("C").alias("portname"),
        F.lit(1).alias("n_tanker"), F.lit(0).alias("n_container"), F.lit(0).alias("n_dry_bulk"), F.lit(1).alias("n_total"),
        F.when(hidden, F.lit(0)).otherwise(F.year("o_orderdate")).cast("bigint").alias("capacity"),
        F.when(hidden, F.lit("1995-01-01").cast("date")).otherwise(F.trunc(day, "year")).alias("event_date"))
    target = fx.with_audit(strict(rows.where(F.col("event_date") < F.lit("1996-01-01").cast("date")), CHOKEPOINTS, optional=UNUSED))
    source = rows.where("portid IS NOT NULL").dropDuplicates(["portid", "event_date"]).withColumn(
        "capacity", F.col("capacity") + F.col("portid").cast("bigint") % 2)
    source = source.unionByName(rows.where("portid IS NULL"))
    return merge.upsert(target, strict(source, CHOKEPOINTS, optional=UNUSED), merge.SPECS["chokepoints"], fx.ts_ntz(fx.AS_OF))


# ----------------------------------------------------------- tables and log
def stats_read(spark: SparkSession, sf: str) -> DataFrame:
    """Write month-partitioned statistics, read 1995-03-15..1995-05-10 back
    (only three month directories are listed and scanned)."""
    return tables.read_stats(spark, _stats_table(spark, sf), "1995-03-15", "1995-05-10").drop(tables.MONTH)


@fx.written
def _stats_table(spark, sf, stamped: bool = False) -> str:
    path = scratch_path(spark, "stats_read")
    rows = fx.with_audit(_order_stats(spark, sf))
    if stamped:  # rows of many loads
        rows = rows.withColumn("updated_at", F.expr("updated_at + make_dt_interval(0, 0, 0, capacity % 86400)"))
    tables.write_months(rows, path)
    return path


def sql_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Ad-hoc SQL over the stored table through a registered view: the five
    most recently updated rows (top-k is the feature)."""
    root, folder = _stats_table(spark, sf, stamped=True).rsplit("/", 1)
    view = f"stats_{abs(hash((spark.sparkContext.applicationId, sf))) % 10**8}"
    tables.register_views(spark, root, {view: (folder, CHOKEPOINTS_LIKE, T.TimestampNTZType())})
    return spark.sql(f"""
        SELECT portid, event_date, n_total, updated_at
        FROM {view}
        ORDER BY updated_at DESC, n_total DESC, portid ASC, event_date DESC
        LIMIT 5""")


def latest_updates(spark: SparkSession, sf: str) -> DataFrame:
    m = upsert_chokepoints(spark, sf)
    return (m.orderBy(F.desc("updated_at"), F.asc("portid"), F.desc("event_date"))
            .limit(5).select("portid", "event_date", "n_total", "updated_at", "action"))


def commit_message(spark: SparkSession, sf: str) -> DataFrame:
    from harborline.plans.jobs import AUTHOR, TABLES

    return commitlog.summary(_port_stats(spark, sf), TABLES["ports"], AUTHOR)


# ------------------------------------------------------------------ zones/AIS
def zone_filter(spark: SparkSession, sf: str) -> DataFrame:
    pts = fx.zone_points(_events(spark, sf)).select("event_id", "latitude", "longitude")
    return in_any_zone(pts, zones_frame(spark))


def zone_filter_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The same match with every zone cut into coarse cells, as zones of more
    than FINE_CELLS fine cells are: same rows as zone_filter."""
    pts = fx.zone_points(_events(spark, sf)).select("event_id", "latitude", "longitude")
    return in_any_zone(pts, zones_frame(spark), fine_cells=0)


def zone_wild(spark: SparkSession, sf: str) -> DataFrame:
    """The match with latitudes that are null, NaN or wild, which lie in no zone."""
    pts = fx.zone_points(_events(spark, sf))
    k = F.col("event_id") % 97
    wild = (F.when(k == 0, F.lit(None)).when(k == 1, F.lit(float("nan"))).when(k == 2, F.lit(1e12)).otherwise(F.col("latitude")))
    return in_any_zone(pts.select("event_id", wild.cast("double").alias("latitude"), "longitude"), zones_frame(spark))


def _parsed(spark, sf):
    return M.parse(fx.landed_messages(spark, sf))


def ais_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).drop("parsed_ok", "ship_id")


def _in_zone(spark, sf):
    return in_any_zone(M.valid_ship(_parsed(spark, sf)), zones_frame(spark))


def ais_positions(spark: SparkSession, sf: str) -> DataFrame:
    return M.positions(_in_zone(spark, sf))


def ais_statics(spark: SparkSession, sf: str) -> DataFrame:
    return M.statics(_in_zone(spark, sf))


def ais_duration(spark: SparkSession, sf: str) -> DataFrame:
    v = M.within_duration(M.valid_ship(_parsed(spark, sf)), STREAM_START, 15 * 86400)
    return v.select("received", "mmsi", "message_type")


def ais_summary(spark: SparkSession, sf: str) -> DataFrame:
    return M.summary(M.within_duration(_in_zone(spark, sf), STREAM_START, STREAM_SECONDS))


def _odd(spark, sf):
    return M.parse(fx.odd_messages(_events(spark, sf)))


def ais_summary_odd(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of a feed with ids and latitudes as text and lines cut off."""
    msgs = in_any_zone(M.valid_ship(_odd(spark, sf)), zones_frame(spark))
    return M.summary(M.within_duration(msgs, STREAM_START, STREAM_SECONDS))


def ais_bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    return M.bad_lines(_odd(spark, sf))


def traffic_job(spark: SparkSession, sf: str) -> DataFrame:
    """The traffic job over everything landed."""
    from harborline.plans import jobs

    return jobs.traffic_summary(spark, fx.landed_messages_path(spark, sf), zones_frame(spark),
                                scratch_path(spark, "traffic_job"), STREAM_SECONDS, STREAM_START)


def ais_summary_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Same answer as ais_summary, computed by a Structured Streaming run over
    the landing files (several micro-batches, append-only message sink)."""
    root = scratch_path(spark, "ais_stream")
    landing = fx.landed_messages_path(spark, sf)
    stream = runner.read_messages(spark, landing, max_files_per_trigger=4)
    flow = runner.traffic(stream, zones_frame(spark), STREAM_START, STREAM_SECONDS)
    runner.run_for(runner.start_sink(flow, f"{root}/sinks"))
    return runner.traffic_summary(spark, f"{root}/sinks")


# what the sink may hold back: two of the fixture's six writes of 5 days
LATE, WINDOW = "10 days", "1 day"


def _sunk(spark, sf, root):
    stream = runner.read_messages(spark, fx.landed_in_order(spark, sf), max_files_per_trigger=16)
    runner.run_for(runner.start_sink(runner.traffic(stream, zones_frame(spark)), root))
    return running.follow_sink(spark, root, max_files_per_trigger=48)


def ais_distinct_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The vessels seen, each appended once by streaming state that follows
    the message sink over several micro-batches."""
    root = scratch_path(spark, "ais_ships")
    running.run_all([running.start(running.ships(_sunk(spark, sf, root)), root, "ships")])
    return running.read_ships(spark, root)


def ais_counts_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The windows that the watermark has closed, with running totals."""
    root = scratch_path(spark, "ais_counts")
    running.run_all([running.start(running.counts(_sunk(spark, sf, root), WINDOW, LATE), root, "counts")])
    return running.read_counts(spark, root)


def ais_running_job(spark: SparkSession, sf: str) -> DataFrame:
    """The traffic job with its running figures, over everything landed."""
    from harborline.plans import jobs

    return jobs.traffic_running(spark, fx.landed_in_order(spark, sf), zones_frame(spark), scratch_path(spark, "ais_running"),
                                window=WINDOW, late=LATE)


def ais_resume_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The totals of a run that was stopped after its first micro-batch and
    started again from its checkpoint: those of one run."""
    root = scratch_path(spark, "ais_resume")
    landing = fx.landed_in_order(spark, sf)

    def query(available_now):
        stream = runner.read_messages(spark, landing, max_files_per_trigger=16)
        return runner.start_sink(runner.traffic(stream, zones_frame(spark), STREAM_START, STREAM_SECONDS), root, available_now)

    runner.run_batches(query(False), 1)
    runner.run_for(query(True))
    return runner.traffic_summary(spark, root)


def zone_traffic(spark: SparkSession, sf: str) -> DataFrame:
    """Messages and distinct vessels of each zone; zones overlap."""
    zones = zones_frame(spark, fx.overlapping_zones())
    return M.zone_traffic(tag_zones(M.valid_ship(_parsed(spark, sf)), zones))


def zone_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Every pair of a point and a zone that it lies in."""
    pts = fx.zone_points(_events(spark, sf)).select("event_id", "latitude", "longitude")
    return tag_zones(pts, zones_frame(spark, fx.overlapping_zones())).select("event_id", "zone")


# ------------------------------------------------- new responses, commits
def _plain_stamps(stored: DataFrame) -> DataFrame:
    return (stored.drop(tables.MONTH).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
            .withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz")))


#: fetch day, event days from and to, whether a tenth of the events is missing yet
FETCHES = [("2024-01-12", "2024-01-01", "2024-01-11", True), ("2024-01-20", "2024-01-09", "2024-01-19", False), ("2024-02-01", "2024-01-18", "2024-01-31", False)]


def incremental_job(spark: SparkSession, sf: str) -> DataFrame:
    """Three fetches land one after the other; after each, a load takes what
    is new. The second and third correct days of the ones before."""
    from harborline.plans import jobs

    base = scratch_path(spark, "incremental")
    ev = _events(spark, sf)
    for fetch_day, first, last, partial in FETCHES:
        rows = ev.where(predicates.between_days(fx.utc_day(ev), first, last))
        rows = rows.where(F.col("event_id") % 10 != 0) if partial else rows
        fx.land_stats(fx.chokepoint_stats(rows, fx.utc_day(ev)), f"{base}/landing", "daily_chokepoint", fetch_day, PAGE_SIZE)
        jobs.load_new_chokepoints(spark, f"{base}/landing", f"{base}/stage", f"{base}/tables", "2024-01-01", "2024-01-31",
                                  now=fx.NOW, as_of=fx.ts_ntz(f"{fetch_day} 00:00:00"))
    return _plain_stamps(jobs.read_stats(spark, f"{base}/tables", "chokepoints"))


def port_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The port scan by ids and range, from a staged landing."""
    base = scratch_path(spark, "port_scan")
    fx.land_stats(_port_stats(spark, sf), f"{base}/landing", "daily_port", "2024-02-01", PAGE_SIZE)
    landing.ingest(spark, f"{base}/landing", f"{base}/stage", "daily_port")
    rows = pg.stat_scan(landing.read_stage(spark, f"{base}/stage", "daily_port"), "daily_port", ids=["1", "2", "3", "10", "100"],
                        start="2024-01-08", end="2024-01-12", now=fx.NOW)
    return strict(rows, PORTS)


def master_job(spark: SparkSession, sf: str) -> DataFrame:
    """Both master tables from stored responses, loaded twice: chokepoints
    (nations below 3, then the same), ports (below 15, then from 10 on).
    Nameless records are dropped."""
    from harborline.plans import jobs

    root = scratch_path(spark, "master_job")
    for ports, stamp in (("s_nationkey < 15", fx.PRIOR_LOAD), ("s_nationkey >= 10", fx.AS_OF)):
        pages = [landing.read_log_once(spark, fx.landed_master_log_path(spark, sf, 50, where, dataset), dataset)
                 for where, dataset in (("s_nationkey < 3", "chokepoints_db"), (ports, "ports_db"))]
        jobs.load_masters(spark, *pages, root, as_of=fx.ts_ntz(stamp))
    stored = [jobs.read_master(spark, root, t).withColumn("table", F.lit(t)) for t in ("chokepoints_master", "ports_master")]
    return _plain_stamps(stored[0].unionByName(stored[1]))


def project_master_text_key(spark: SparkSession, sf: str) -> DataFrame:
    """Master rows whose missing keys are kept as the text 'None'."""
    m = _master(spark, sf)
    key = F.when(F.try_variant_get("portid", "$", "bigint") % 19 != 0, F.col("portid"))
    return lenient(m.withColumn("portid", key), MASTER, null_key="text")


def default_window_job(spark: SparkSession, sf: str) -> DataFrame:
    """A load of the default window, then one that finds no rows: it writes
    and logs nothing, so the log still has one row."""
    from harborline.plans import jobs

    base = scratch_path(spark, "default_window")
    root, stats = f"{base}/tables", _chk_stats(spark, sf)
    for fetch_day, part in (("2024-02-01", stats), ("2024-02-02", stats.where(predicates.between_days("event_date", "2024-01-01", "2024-01-05")))):
        fx.land_stats(part, f"{base}/landing", "daily_chokepoint", fetch_day, PAGE_SIZE)
        jobs.load_new_chokepoints(spark, f"{base}/landing", f"{base}/stage", root, now=fx.NOW, as_of=fx.ts_ntz(fx.AS_OF))
    n_commits = jobs.commits(spark, root, "chokepoints").count()
    return _plain_stamps(jobs.read_stats(spark, root, "chokepoints")).withColumn("n_commits", F.lit(n_commits).cast("bigint"))


def _three_loads(spark, sf):
    """A prior load, the backfill, and a later load of the last days."""
    from harborline.plans import jobs

    root = scratch_path(spark, "commits")
    ev = _events(spark, sf)
    jobs.load_stats(spark, fx.port_stats(ev.where(F.col("ts") < fx.ts_ntz(TARGET_BEFORE)), fx.shifted_day(ev)), root, "ports", as_of=fx.ts_ntz(fx.PRIOR_LOAD))
    jobs.backfill_ports(spark, [*_backfill_feeds(ev)], root, "2024-01-10", "2024-01-25", as_of=fx.ts_ntz(fx.AS_OF))
    jobs.load_stats(spark, _port_stats(spark, sf).where("event_date >= '2024-01-20'"), root, "ports", as_of=fx.ts_ntz("2024-02-05 00:00:00"))
    return root, [r["snapshot"] for r in jobs.commits(spark, root, "ports").collect()]


def stats_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """The table as it was after the second of three commits."""
    from harborline.plans import jobs

    root, snapshots = _three_loads(spark, sf)
    return _plain_stamps(jobs.read_stats(spark, root, "ports", commit=snapshots[1]))


def commit_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that the second of three commits wrote anew or changed."""
    from harborline.plans import jobs

    root, snapshots = _three_loads(spark, sf)
    changed = jobs.commit_changes(spark, root, "ports", snapshots[1])
    return _plain_stamps(changed.where("action IN ('insert', 'update')"))


QUERIES = {
    "upsert_chokepoints": upsert_chokepoints,
    "upsert_ports": upsert_ports,
    "upsert_master": upsert_master,
    "upsert_dry_run": upsert_dry_run,
    "upsert_duplicates": upsert_duplicates,
    "backfill_ports": backfill_ports,
    "backfill_job": backfill_job,
    "project_chokepoints": project_chokepoints,
    "project_ports": project_ports,
    "project_master": project_master,
    "master_scan": master_scan,
    "epoch_to_date": epoch_to_date,
    "page_corrupt": page_corrupt,
    "stat_scan_mixed": stat_scan_mixed,
    "chokepoint_scan": chokepoint_scan,
    "chokepoint_job": chokepoint_job,
    "page_one": page_one,
    "upsert_hot_target": upsert_hot_target,
    "zone_wild": zone_wild,
    "ais_summary_odd": ais_summary_odd,
    "ais_bad_lines": ais_bad_lines,
    "traffic_job": traffic_job,
    "month_partition": month_partition,
    "filter_range": filter_range,
    "filter_since": filter_since,
    "filter_days": filter_days,
    "filter_day": filter_day,
    "filter_ids": filter_ids,
    "chokepoint_recent": chokepoint_recent,
    "port_range": port_range,
    "day_calendar": day_calendar,
    "stat_scan": stat_scan,
    "page_stop": page_stop,
    "page_slice": page_slice,
    "stat_order": stat_order,
    "stats_read": stats_read,
    "latest_updates": latest_updates,
    "sql_latest": sql_latest,
    "commit_message": commit_message,
    "zone_filter": zone_filter,
    "zone_filter_grid": zone_filter_grid,
    "ais_parse": ais_parse,
    "ais_positions": ais_positions,
    "ais_statics": ais_statics,
    "ais_duration": ais_duration,
    "ais_summary": ais_summary,
    "ais_summary_stream": ais_summary_stream,
    "ais_distinct_stream": ais_distinct_stream,
    "ais_counts_stream": ais_counts_stream,
    "ais_running_job": ais_running_job,
    "ais_resume_stream": ais_resume_stream,
    "zone_traffic": zone_traffic,
    "zone_tags": zone_tags,
    "incremental_job": incremental_job,
    "port_scan": port_scan,
    "master_job": master_job,
    "project_master_text_key": project_master_text_key,
    "default_window_job": default_window_job,
    "stats_as_of": stats_as_of,
    "commit_changes": commit_changes,
    "commit_range": commit_range,
    "page_seek": page_seek,
    "stats_by_id": stats_by_id,
    "upsert_narrow": upsert_narrow,
}
