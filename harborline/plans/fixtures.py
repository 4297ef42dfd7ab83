"""Inputs in the shapes of the statistics service and the message feed, derived
by Spark from the driver's tables (so every query grows with them).

Mapping (a fixture choice, not a behaviour of the loads):
  events.user_id     -> portid / vessel id (MMSI); user 0 is an invalid MMSI
  events.event_type  -> vessel kind / message type:
        view -> tanker / PositionReport
        click -> container / StandardClassBPositionReport
        signup -> dry_bulk / ShipStaticData
        purchase -> general_cargo (other message type)
        error -> roro (other message type)
  cargo = every kind but tanker; capacity = sum of integer cents of `value`
  import/export = cents of events with even/odd event_id, divided by 100
  supplier + nation -> master records (values as numbers or as text)
"""

from __future__ import annotations

import functools
import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.schemas import MASTER_ATTRS
from harborline.sources.zones import SHIPPED_ZONES

KIND_OF_TYPE = {  # fixture mapping of event types to vessel kinds
    "tanker": "view",
    "container": "click",
    "dry_bulk": "signup",
    "general_cargo": "purchase",
    "roro": "error",
}

AS_OF = "2024-02-01 00:00:00"        # stamp of the load under test
PRIOR_LOAD = "2024-01-21 00:00:00"   # stamp of the rows already in the table
NOW = "2024-01-31"                   # "today" of the relative date windows


#: Seconds spent on writing stand-in feeds and tables, for the benchmark: what
#: it times is the query without them.
written_seconds = 0.0


def written(fn):
    """Marks a function that writes a stand-in; its time is added up."""
    @functools.wraps(fn)
    def run(*args, **kwargs):
        global written_seconds
        t0 = time.perf_counter()
        try:
            return fn(*args, **kwargs)
        finally:
            written_seconds += time.perf_counter() - t0

    return run


def ts_ntz(text: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def epoch_millis_utc(col: str) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ read as UTC (session-zone free)."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {col})")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def utc_day(events: DataFrame) -> Column:
    return F.to_date(F.col("ts"))


def shifted_day(events: DataFrame, hours: int = 9) -> Column:
    """Day of an earlier load that bucketed days in a UTC+9 local zone."""
    return F.to_date(F.col("ts") + F.expr(f"INTERVAL {hours} HOURS"))


CENTS_SQL = "CAST(round(value * 100) AS BIGINT)"
KINDS = ["tanker", "container", "dry_bulk", "general_cargo", "roro", "cargo"]


def _cents() -> Column:
    return F.expr(CENTS_SQL)


def _kind_sql(kind: str) -> str:
    if kind == "cargo":
        return "event_type <> 'view'"
    return f"event_type = '{KIND_OF_TYPE[kind]}'"


def _is_kind(kind: str) -> Column:
    return F.expr(_kind_sql(kind))


def _grouped(events: DataFrame, day: Column, aggs: list[str]) -> DataFrame:
    # aggregate expressions as SQL text: one call per column when building
    return events.groupBy(F.col("user_id"), day.alias("event_date")).agg(
        *[F.expr(a) for a in aggs])


def chokepoint_stats(events: DataFrame, day: Column) -> DataFrame:
    """Daily chokepoint statistics in table types (one row per port and day)."""
    aggs = [f"CAST(count_if({_kind_sql(k)}) AS INT) AS n_{k}" for k in KINDS]
    aggs += ["CAST(count(1) AS INT) AS n_total", f"sum({CENTS_SQL}) AS capacity"]
    return _grouped(events, day, aggs).selectExpr(
        "CAST(user_id AS STRING) AS portid", "concat('Chokepoint ', user_id) AS portname",
        *[f"n_{k}" for k in KINDS], "n_total", "capacity", "event_date")


def _money(cond: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {cond} THEN {CENTS_SQL} END), 0) AS DOUBLE) / 100.0D"


def port_stats(events: DataFrame, day: Column) -> DataFrame:
    """Daily port statistics in table types (one row per port and day)."""
    even, odd = "event_id % 2 = 0", "event_id % 2 <> 0"
    aggs = [f"CAST(count_if({_kind_sql(k)}) AS INT) AS portcalls_{k}" for k in KINDS]
    aggs.append("CAST(count(1) AS INT) AS portcalls")
    aggs += [f"{_money(even + ' AND ' + _kind_sql(k))} AS import_{k}" for k in KINDS]
    aggs.append(f"{_money(even)} AS `import`")
    aggs += [f"{_money(odd + ' AND ' + _kind_sql(k))} AS export_{k}" for k in KINDS]
    aggs.append(f"{_money(odd)} AS `export`")
    return _grouped(events, day, aggs).selectExpr(
        "CAST(user_id AS STRING) AS portid", "concat('Port ', user_id) AS portname",
        "concat('NATION_', user_id % 25) AS country",
        "concat('N', lpad(CAST(user_id % 25 AS STRING), 2, '0')) AS iso3",
        *[f"`{c}`" for c in aggs_names(KINDS)], "event_date")


def aggs_names(kinds):
    return ([f"portcalls_{k}" for k in kinds] + ["portcalls"]
            + [f"import_{k}" for k in kinds] + ["import"]
            + [f"export_{k}" for k in kinds] + ["export"])


def with_audit(df: DataFrame, stamp: str = PRIOR_LOAD) -> DataFrame:
    return df.withColumn("created_at", ts_ntz(stamp)).withColumn("updated_at", ts_ntz(stamp))


def raw_attributes(stats: DataFrame) -> DataFrame:
    """Table rows back in the service's raw form: `date` as epoch-ms text,
    `ISO3` upper-case, counts as 64-bit numbers."""
    cols = []
    for name, dtype in stats.dtypes:
        if name == "event_date":
            cols.append((F.unix_date(F.col("event_date")).cast("bigint") * 86400000)
                        .cast("string").alias("date"))
        elif name == "iso3":
            cols.append(F.col(name).alias("ISO3"))
        elif dtype == "int":
            cols.append(F.col(name).cast("bigint"))
        else:
            cols.append(F.col(name))
    return stats.select(*cols)


# ---------------------------------------------------------------------------
# master records
# ---------------------------------------------------------------------------
def master_json(spark: SparkSession, sf_dir: str, nameless: bool = False) -> DataFrame:
    """Master attributes as JSON text (numbers and text mixed, NaN and n/a).
    `nameless`: every 23rd record has a null name, every 29th an empty one."""
    s = read(spark, sf_dir, "supplier")
    n = read(spark, sf_dir, "nation")
    k = F.col("s_suppkey")
    j = s.join(n, s.s_nationkey == n.n_nationkey, "left")
    attrs = F.struct(
        k.alias("portid"),
        (F.when(k % 23 == 0, F.lit(None)).when(k % 29 == 0, F.lit("")).otherwise(F.col("s_name")) if nameless else F.col("s_name")).alias("portname"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("N"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).alias("ISO3"),
        F.concat(F.lit("REGION_"), F.col("n_regionkey")).alias("continent"),
        F.concat_ws(", ", F.col("s_name"), F.col("n_name")).alias("fullname"),
        (F.col("s_acctbal") / F.lit(200.0)).alias("lat"),
        (F.col("s_nationkey") * F.lit(7.5) - F.lit(90.0)).alias("lon"),
        F.when(k % 7 == 3, F.lit("n/a")).otherwise((k % 97).cast("string")).alias("vessel_count_total"),
        (k % 13).alias("vessel_count_container"),
        (F.col("s_nationkey") * 3).cast("string").alias("vessel_count_dry_bulk"),
        F.when(k % 5 == 0, F.lit(None).cast("bigint")).otherwise(k % 11).alias("vessel_count_general_cargo"),
        (k % 17).alias("vessel_count_RoRo"),
        F.col("s_acctbal").alias("vessel_count_tanker"),
        F.concat(F.lit("IND_"), k % 4).alias("industry_top1"),
        F.concat(F.lit("IND_"), k % 6).alias("industry_top2"),
        F.when(k % 9 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("IND_"), k % 8)).alias("industry_top3"),
        (F.col("s_acctbal") / F.lit(10000.0)).alias("share_country_maritime_import"),
        F.when(k % 11 == 0, F.lit(float("nan")))
         .otherwise(F.col("s_nationkey") / F.lit(25.0)).alias("share_country_maritime_export"),
        F.concat(F.lit("L"), k).alias("LOCODE"),
        (k * 3).cast("string").alias("pageid"),
        F.lower(F.col("n_name")).alias("countrynoaccents"),
    )
    text = F.to_json(attrs, {"ignoreNullFields": "false"})
    # JSON writers quote NaN; the service sends the bare non-standard token
    text = F.regexp_replace(text, '"NaN"', "NaN")
    return j.select("s_suppkey", "s_nationkey", text.alias("json"))


def master_page_text(spark: SparkSession, sf_dir: str, size: int, where: str = "true", dataset: str = "ports_db") -> DataFrame:
    """Master records as service responses (request, offset, body): one paged
    request per block of 100,000 ids, `size` records a page, the last page of
    each request not flagged as truncated."""
    block = Window.partitionBy("request")
    m = master_json(spark, sf_dir, nameless=True).where(where).withColumn(
        "request", F.concat(F.lit(f"{dataset}:"), F.floor((F.col("s_suppkey") - 1) / 100000).cast("string")))
    m = m.withColumn("rn", F.row_number().over(block.orderBy("s_suppkey")) - 1).withColumn("n", F.count(F.lit(1)).over(block))
    pages = (m.withColumn("page", F.floor(F.col("rn") / size).cast("int"))
             .groupBy("request", "page")
             .agg(F.collect_list("json").alias("attrs"),  # at most `size` records
                  F.max(F.col("rn") == F.col("n") - 1).alias("is_last")))
    body = F.concat(F.lit('{"features":['),
                    F.array_join(F.transform("attrs", lambda a: F.concat(F.lit('{"attributes":'), a, F.lit("}"))), ","),
                    F.lit('],"exceededTransferLimit":'),
                    F.when(F.col("is_last"), F.lit("false")).otherwise(F.lit("true")),
                    F.lit("}"))
    return pages.select("request", (F.col("page") * size).alias("offset"), body.alias("body"))


def master_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master attributes as the page scan yields them (variant values)."""
    m = master_json(spark, sf_dir)
    return m.select("s_nationkey", F.from_json("json", MASTER_ATTRS).alias("a")).select(
        "s_nationkey", "a.*")


# ---------------------------------------------------------------------------
# pages of the statistics service
# ---------------------------------------------------------------------------
def page_requests(rows: DataFrame, page_size: int, inject_stops: bool, cut_page: int | None = None) -> DataFrame:
    """Group numbered attribute rows (`request`, `rn`, `attributes` struct) into
    response pages as JSON text; `cut_page`: the text of that page of each
    request ends in the middle."""
    pg = (rows.withColumn("page", F.floor(F.col("rn") / page_size).cast("int"))
          .groupBy("request", "page")
          .agg(F.collect_list("attributes").alias("attrs"),
               F.max("last").alias("is_last")))
    dom = F.dayofmonth(F.to_date("request"))
    truncated = ~F.col("is_last")
    if inject_stops:
        truncated = truncated & ~((dom % 5 == 0) & (F.col("page") == 1))
    body = F.struct(
        F.transform("attrs", lambda a: F.struct(a.alias("attributes"))).alias("features"),
        truncated.alias("exceededTransferLimit"))
    err = F.to_json(F.struct(F.struct(F.lit(400).alias("code"),
                                      F.lit("Invalid query parameters").alias("message"))
                             .alias("error")))
    text = F.to_json(body)
    if inject_stops:
        text = F.when((dom % 7 == 3) & (F.col("page") == 2), err).otherwise(text)
    if cut_page is not None:
        text = F.when(F.col("page") == cut_page, F.expr("left(body, CAST(length(body) * 2 / 3 AS INT))")).otherwise(F.col("body"))
        return pg.withColumn("body", F.to_json(body)).select("request", (F.col("page") * page_size).alias("offset"), text.alias("body"))
    return pg.select("request", (F.col("page") * page_size).alias("offset"),
                     text.alias("body"))


def mixed_counts(rows: DataFrame) -> DataFrame:
    """The records with `n_total` as the service may send it: 1, "1", 1.0 or
    null, by the record's place in its request."""
    form = F.element_at(F.array(F.lit("1"), F.lit('"1"'), F.lit("1.0"), F.lit("null")), (F.col("rn") % 4 + 1).cast("int"))
    return rows.withColumn("attributes", F.col("attributes").withField("n_total", F.parse_json(form)))


def event_attributes(events: DataFrame) -> DataFrame:
    """One raw statistics record per event (the finest grain the service could
    publish): portid, portname, date epoch-ms, counts of one vessel, capacity."""
    day = F.to_date("ts")
    first = events.groupBy(day.alias("day")).agg(
        F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))
    kinds = ["tanker", "container", "dry_bulk", "general_cargo", "roro", "cargo"]
    attrs = F.struct(
        (F.unix_date(day).cast("bigint") * 86400000).cast("string").alias("date"),
        F.col("user_id").cast("string").alias("portid"),
        F.concat(F.lit("Chokepoint "), F.col("user_id")).alias("portname"),
        *[_is_kind(k).cast("bigint").alias(f"n_{k}") for k in kinds],
        F.lit(1).cast("bigint").alias("n_total"),
        _cents().alias("capacity"),
    )
    return (events.join(first, day == F.col("day"))
            .select(F.col("day").cast("string").alias("request"),
                    (F.col("event_id") - F.col("first_id")).alias("rn"),
                    (F.col("event_id") == F.col("last_id")).alias("last"),
                    attrs.alias("attributes")))


# ---------------------------------------------------------------------------
# vessel messages
# ---------------------------------------------------------------------------
MESSAGE_TYPE = {  # fixture mapping of event types to message types
    "view": "PositionReport",
    "click": "StandardClassBPositionReport",
    "signup": "ShipStaticData",
    "purchase": "SafetyBroadcastMessage",
    "error": "DataLinkManagementMessage",
}


def zone_points(events: DataFrame) -> DataFrame:
    """Place each event at a point relative to one shipped zone: zone
    `event_id % 28`; step k = (event_id div 28) % 4 moves the latitude from the
    SW corner by k half-heights (k = 0..2 inside or on the edge, k = 3 outside);
    longitude at the zone centre (plain IEEE arithmetic, no rounding)."""
    table = "array(" + ", ".join(
        f"named_struct('lat1', {z[1]!r}D, 'lon1', {z[2]!r}D, 'lat2', {z[3]!r}D, 'lon2', {z[4]!r}D)"
        for z in SHIPPED_ZONES) + ")"
    z = F.expr(f"element_at({table}, CAST(event_id % {len(SHIPPED_ZONES)} + 1 AS INT))")
    k = (F.floor(F.col("event_id") / 28) % 4).cast("double")
    return (events
            .withColumn("latitude", z["lat1"] + (z["lat2"] - z["lat1"]) * k * 0.5)
            .withColumn("longitude", (z["lon1"] + z["lon2"]) / 2))


def messages(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Vessel messages as the feed delivers them: (received, value JSON text).

    Names are padded with blanks, tabs and newlines; every 10th vessel sends a
    null name; static messages carry a destination that is set, explicitly
    null, or absent (by event_id % 3), and every 13th static message has no
    ShipStaticData object at all.
    """
    p = zone_points(events)
    mtype = F.coalesce(*[F.when(F.col("event_type") == et, F.lit(mt)) for et, mt in MESSAGE_TYPE.items()])
    uid = F.col("user_id")
    name = (F.when(uid % 10 == 9, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit(" \t"), F.lit("VESSEL "), uid, F.lit(" \n"))))
    meta = F.struct(uid.alias("MMSI"), name.alias("ShipName"),
                    F.col("latitude"), F.col("longitude"))
    dest_kind = F.col("event_id") % 3
    static_set = F.struct(F.concat(F.lit("PORT "), uid % 40).alias("Destination"),
                          F.lit(1).alias("Type"))
    static_null = F.struct(F.lit(None).cast("string").alias("Destination"), F.lit(1).alias("Type"))
    static_absent = F.struct(F.lit(1).alias("Type"))

    def msg(static):
        return F.to_json(F.struct(mtype.alias("MessageType"), meta.alias("MetaData"),
                                  F.struct(static.alias("ShipStaticData")).alias("Message")),
                         {"ignoreNullFields": "false"})

    no_static = F.to_json(F.struct(mtype.alias("MessageType"), meta.alias("MetaData"),
                                   F.struct(F.lit(0).alias("Other")).alias("Message")),
                          {"ignoreNullFields": "false"})
    value = (F.when(mtype != "ShipStaticData", no_static)
             .when(F.col("event_id") % 13 == 0, no_static)
             .when(dest_kind == 0, msg(static_set))
             .when(dest_kind == 1, msg(static_null))
             .otherwise(msg(static_absent)))
    return p.select(F.col("ts").alias("received"), value.alias("value"), *(F.col(c) for c in keep))


def odd_messages(events: DataFrame) -> DataFrame:
    """The feed with odd lines: ids as text (event_id % 5 = 1), latitudes as
    text (event_id % 7 = 2), and lines cut off (event_id % 50 = 0)."""
    value = F.col("value")
    e = F.col("event_id")
    value = F.when((e % 5 == 1) & (F.col("user_id") != 0), F.regexp_replace(value, '"MMSI":([0-9]+)', '"MMSI":"$1"')).otherwise(value)
    value = F.when(e % 7 == 2, F.regexp_replace(value, '"latitude":([^,]+),', '"latitude":"$1",')).otherwise(value)
    value = F.when(e % 50 == 0, F.substring(value, 1, 30)).otherwise(value)
    return messages(events, keep=("event_id", "user_id")).select("received", value.alias("value"))


def landed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("received timestamp_ntz, value string").parquet(
        landed_messages_path(spark, sf_dir))


@written
def landed_messages_path(spark: SparkSession, sf_dir: str) -> str:
    """The message feed as landing files in the shared scratch folder (what a
    collector writes before the stream reads it), then read back like any
    landing table."""
    from harborline.session import scratch_path, spread

    path = scratch_path(spark, "ais_landing")
    messages(spread(read(spark, sf_dir, "events"))).write.parquet(path)
    return path


@written
def landed_in_order(spark: SparkSession, sf_dir: str, steps: int = 6) -> str:
    """The feed landed in `steps` writes, one after the other in the order of
    arrival, as a collector does; each covers an equal span of time."""
    from harborline.session import scratch_path, spread

    path = scratch_path(spark, "ais_ordered")
    events = spread(read(spark, sf_dir, "events"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    bounds = [first + (last - first) / steps * i for i in range(1, steps)]
    for lo, hi in zip([None, *bounds], [*bounds, None]):
        part = events if lo is None else events.where(F.col("ts") >= ts_ntz(str(lo)))
        part = part if hi is None else part.where(F.col("ts") < ts_ntz(str(hi)))
        messages(part).coalesce(8).write.mode("append").parquet(path)
    return path


def overlapping_zones() -> list[tuple]:
    """The shipped zones, their surroundings (a degree more on each side), and
    two of many cells that lie over some of them."""
    near = [(f"Off {z[0]}", z[1] - 1.0, z[2] - 1.0, z[3] + 1.0, z[4] + 1.0) for z in SHIPPED_ZONES]
    return SHIPPED_ZONES + near + [("East", -60.0, 90.0, 60.0, 180.0), ("Tropics", -23.5, -180.0, 23.5, 180.0)]


@written
def landed_pages_path(spark: SparkSession, sf_dir: str, page_size: int, inject_stops: bool,
                      cut_page: int | None = None, mixed: bool = False) -> str:
    """Service responses stored as a page log (JSON lines with a request/offset
    envelope, as a downloader appends them), built from `events` and read back
    with the page-log reader."""
    from harborline.session import scratch_path, spread

    from harborline.sources.pages import page_log_lines

    path = scratch_path(spark, "pages")
    rows = event_attributes(spread(read(spark, sf_dir, "events")))
    rows = mixed_counts(rows) if mixed else rows
    page_log_lines(page_requests(rows, page_size, inject_stops, cut_page)).write.text(path)
    return path


@written
def land_stats(stats: DataFrame, landing: str, dataset: str, fetch_day: str, page_size: int) -> None:
    """One day's fetch of `stats` (table rows) in the landing: a request for
    each event day, `page_size` records a page."""
    from harborline.sources.pages import page_log_lines

    day = Window.partitionBy("event_date")
    rows = stats.withColumn("request", F.concat(F.lit(f"{fetch_day}/"), F.col("event_date").cast("string")))
    rows = rows.withColumn("rn", F.row_number().over(day.orderBy("portid")) - 1).withColumn("last", F.col("rn") == F.count(F.lit(1)).over(day) - 1)
    raw = raw_attributes(rows.drop("request", "rn", "last")).columns
    date = (F.unix_date("event_date").cast("bigint") * 86400000).cast("string").alias("date")
    fields = [date if c == "date" else F.col("iso3").alias("ISO3") if c == "ISO3" else F.col(c) for c in raw]
    pages = page_requests(rows.select("request", "rn", "last", F.struct(*fields).alias("attributes")), page_size, False)
    page_log_lines(pages).write.text(f"{landing}/{dataset}/fetch_day={fetch_day}")


@written
def landed_master_log_path(spark: SparkSession, sf_dir: str, size: int, where: str = "true", dataset: str = "ports_db") -> str:
    """Master responses as a page log in the scratch folder, read back through
    the page-log reader with variant values."""
    from harborline.session import scratch_path
    from harborline.sources.pages import page_log_lines

    path = scratch_path(spark, "master-pages")
    page_log_lines(master_page_text(spark, sf_dir, size, where, dataset)).write.text(path)
    return path
