"""DuckDB text of every registered query (tables are pre-registered views).

The oracle computes each answer directly from the driver's tables, without
the intermediate shapes (pages, JSON messages) the Spark queries go through.
"""

from __future__ import annotations

from typing import NamedTuple

# Everything below is stated in full here, not taken from the library: keys,
# triggers, update lists, names, stamps and zones of the loads under test.
AS_OF, PRIOR_LOAD = '2024-02-01 00:00:00', '2024-01-21 00:00:00'
PORTS_TABLE = 'portwatch.ports'


class Spec(NamedTuple):
    keys: tuple
    columns: tuple
    trigger: tuple | None
    update_cols: tuple


SPECS = {
    "chokepoints": Spec(
        keys=('portid', 'event_date'),
        columns=('portid', 'portname', 'n_tanker', 'n_container', 'n_dry_bulk', 'n_general_cargo', 'n_roro',
            'n_cargo', 'n_total', 'capacity', 'event_date',),
        trigger=('n_total', 'capacity',),
        update_cols=('n_tanker', 'n_container', 'n_dry_bulk', 'n_general_cargo', 'n_roro', 'n_cargo', 'n_total',
            'capacity',),
    ),
    "ports": Spec(
        keys=('portid', 'event_date'),
        columns=('portid', 'portname', 'country', 'iso3', 'portcalls_tanker', 'portcalls_container',
            'portcalls_dry_bulk', 'portcalls_general_cargo', 'portcalls_roro',
            'portcalls_cargo', 'portcalls', 'import_tanker', 'import_container',
            'import_dry_bulk', 'import_general_cargo', 'import_roro', 'import_cargo',
            'import', 'export_tanker', 'export_container', 'export_dry_bulk',
            'export_general_cargo', 'export_roro', 'export_cargo', 'export', 'event_date',),
        trigger=('portcalls', 'import', 'export',),
        update_cols=('portcalls_tanker', 'portcalls_container', 'portcalls_dry_bulk', 'portcalls_general_cargo',
            'portcalls_roro', 'portcalls_cargo', 'portcalls', 'import_tanker',
            'import_container', 'import_dry_bulk', 'import_general_cargo', 'import_roro',
            'import_cargo', 'import', 'export_tanker', 'export_container',
            'export_dry_bulk', 'export_general_cargo', 'export_roro', 'export_cargo',
            'export',),
    ),
    "master": Spec(
        keys=('portid',),
        columns=('portid', 'portname', 'country', 'iso3', 'continent', 'fullname', 'lat', 'lon',
            'vessel_count_total', 'vessel_count_container', 'vessel_count_dry_bulk',
            'vessel_count_general_cargo', 'vessel_count_roro', 'vessel_count_tanker',
            'industry_top1', 'industry_top2', 'industry_top3',
            'share_country_maritime_import', 'share_country_maritime_export', 'locode',
            'pageid', 'countrynoaccents',),
        trigger=None,
        update_cols=('portname', 'country', 'iso3', 'continent', 'fullname', 'lat', 'lon', 'vessel_count_total',
            'vessel_count_container', 'vessel_count_dry_bulk', 'vessel_count_general_cargo',
            'vessel_count_roro', 'vessel_count_tanker', 'industry_top1', 'industry_top2',
            'industry_top3', 'share_country_maritime_import',
            'share_country_maritime_export', 'locode', 'pageid', 'countrynoaccents',),
    ),
}

# name, lat1, lon1, lat2, lon2
SHIPPED_ZONES = [
    ('Suez Canal', 30.0933, 31.9369, 31.0933, 32.9369),
    ('Panama Canal', 8.90949, -79.97498, 9.43281, -79.45587),
    ('Bosporus Strait', 40.98508, 28.95721, 41.23961, 29.16733),
    ('Bab el-Mandeb Strait', 12.4473, 43.20374, 12.86536, 43.6322),
    ('Malacca Strait', 2.74553, 99.00879, 5.02528, 101.90918),
    ('Strait of Hormuz', 25.7969, 56.3598, 26.7969, 57.3598),
    ('Cape of Good Hope', -35.90685, 17.66602, -33.44978, 27.00439),
    ('Gibraltar Strait', 35.65283, -5.92712, 36.19553, -5.32837),
    ('Dover Strait', 50.82676, 1.27441, 51.17934, 1.66992),
    ('Oresund Strait', 55.60318, 12.50244, 56.0078, 13.1012),
    ('Taiwan Strait', 23.09994, 116.71875, 27.37177, 121.37695),
    ('Korea Strait', 33.25706, 128.37524, 35.24562, 130.61646),
    ('Tsugaru Strait', 41.17038, 140.18005, 41.81636, 140.89417),
    ('Luzon Strait', 19.9889, 120.8523, 20.9889, 121.8523),
    ('Lombok Strait', -8.51584, 115.60913, -8.32021, 116.10901),
    ('Ombai Strait', -8.62447, 125.08484, -8.27401, 125.56274),
    ('Bohai Strait', 37.77506, 120.56946, 38.78835, 121.20667),
    ('Torres Strait', -10.96816, 142.21802, -9.19429, 142.66846),
    ('Sunda Strait', -6.07228, 105.72693, -5.83462, 105.96039),
    ('Makassar Strait', 0.0769, 118.78418, 1.02167, 119.90479),
    ('Magellan Strait', -52.53296, -69.63135, -52.44598, -69.5105),
    ('Yucatan Channel', 21.08963, -86.92383, 22.41103, -83.93555),
    ('Windward Passage', 19.68397, -74.1975, 20.2725, -73.31177),
    ('Mona Passage', 18.0832, -68.44482, 18.65665, -67.00562),
    ('Balabac Strait', 6.92643, 116.69128, 8.3963, 117.30103),
    ('Bering Strait', 65.52207, -169.99707, 66.16051, -167.76123),
    ('Mindoro Strait', 12.09304, 120.17944, 12.80109, 120.91553),
    ('Kerch Strait', 45.08904, 36.38123, 45.47939, 36.8866),
]

KINDS = ["tanker", "container", "dry_bulk", "general_cargo", "roro", "cargo"]
TYPE_OF = {"tanker": "view", "container": "click", "dry_bulk": "signup",
           "general_cargo": "purchase", "roro": "error"}

UTC_DAY = "CAST(ts AS DATE)"
SHIFTED_DAY = "CAST(ts + INTERVAL 9 HOUR AS DATE)"
CENTS = "CAST(round(value * 100) AS BIGINT)"


def q(name: str) -> str:
    return f'"{name}"'


def _is_kind(k: str) -> str:
    return "event_type <> 'view'" if k == "cargo" else f"event_type = '{TYPE_OF[k]}'"


def chk_stats(where: str = "TRUE", day: str = UTC_DAY) -> str:
    counts = ",\n  ".join(
        f"CAST(count_if({_is_kind(k)}) AS INTEGER) AS n_{k}" for k in KINDS)
    return f"""SELECT CAST(user_id AS VARCHAR) AS portid,
  'Chokepoint ' || CAST(user_id AS VARCHAR) AS portname,
  {counts},
  CAST(count(*) AS INTEGER) AS n_total,
  CAST(sum({CENTS}) AS BIGINT) AS capacity,
  {day} AS event_date
FROM events WHERE {where} GROUP BY user_id, {day}"""


def _money(cond: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {cond} THEN {CENTS} END), 0) AS DOUBLE) / 100.0"


def port_cols(drop=()) -> list[str]:
    return ([f"portcalls_{k}" for k in KINDS] + ["portcalls"]
            + [f"import_{k}" for k in KINDS] + ["import"]
            + [f"export_{k}" for k in KINDS] + ["export"])


def port_stats(where: str = "TRUE", day: str = UTC_DAY, drop=()) -> str:
    even, odd = "event_id % 2 = 0", "event_id % 2 <> 0"
    parts = [f"CAST(count_if({_is_kind(k)}) AS INTEGER) AS portcalls_{k}" for k in KINDS]
    parts.append("CAST(count(*) AS INTEGER) AS portcalls")
    parts += [f"{_money(even + ' AND ' + _is_kind(k))} AS import_{k}" for k in KINDS]
    parts.append(f"{_money(even)} AS {q('import')}")
    parts += [f"{_money(odd + ' AND ' + _is_kind(k))} AS export_{k}" for k in KINDS]
    parts.append(f"{_money(odd)} AS {q('export')}")
    parts = [p if not any(p.endswith(f" AS {d}") for d in drop) else
             f"CAST(NULL AS DOUBLE) AS {p.rsplit(' AS ', 1)[1]}" for p in parts]
    body = ",\n  ".join(parts)
    return f"""SELECT CAST(user_id AS VARCHAR) AS portid,
  'Port ' || CAST(user_id AS VARCHAR) AS portname,
  'NATION_' || CAST(user_id % 25 AS VARCHAR) AS country,
  'N' || lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS iso3,
  {body},
  {day} AS event_date
FROM events WHERE {where} GROUP BY user_id, {day}"""


def with_audit(sql: str, stamp: str = PRIOR_LOAD) -> str:
    return (f"SELECT *, TIMESTAMP '{stamp}' AS created_at, TIMESTAMP '{stamp}' AS updated_at "
            f"FROM ({sql})")


MASTER_SQL = """SELECT CAST(s_suppkey AS VARCHAR) AS portid,
  s_name AS portname,
  n_name AS country,
  'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS iso3,
  'REGION_' || CAST(n_regionkey AS VARCHAR) AS continent,
  s_name || ', ' || n_name AS fullname,
  s_acctbal / 200.0 AS lat,
  CAST(s_nationkey AS DOUBLE) * 7.5 - 90.0 AS lon,
  CAST(CASE WHEN s_suppkey % 7 = 3 THEN NULL ELSE s_suppkey % 97 END AS BIGINT) AS vessel_count_total,
  CAST(s_suppkey % 13 AS BIGINT) AS vessel_count_container,
  CAST(s_nationkey * 3 AS BIGINT) AS vessel_count_dry_bulk,
  CAST(CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_suppkey % 11 END AS BIGINT) AS vessel_count_general_cargo,
  CAST(s_suppkey % 17 AS BIGINT) AS vessel_count_roro,
  CAST(trunc(s_acctbal) AS BIGINT) AS vessel_count_tanker,
  'IND_' || CAST(s_suppkey % 4 AS VARCHAR) AS industry_top1,
  'IND_' || CAST(s_suppkey % 6 AS VARCHAR) AS industry_top2,
  CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE 'IND_' || CAST(s_suppkey % 8 AS VARCHAR) END AS industry_top3,
  s_acctbal / 10000.0 AS share_country_maritime_import,
  CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST(s_nationkey AS DOUBLE) / 25.0 END AS share_country_maritime_export,
  'L' || CAST(s_suppkey AS VARCHAR) AS locode,
  CAST(s_suppkey * 3 AS VARCHAR) AS pageid,
  lower(n_name) AS countrynoaccents,
  s_nationkey
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""

MASTER_COLS = list(SPECS["master"].columns)


def master(where: str = "TRUE") -> str:
    cols = ", ".join(MASTER_COLS)
    return f"SELECT {cols} FROM ({MASTER_SQL}) WHERE {where}"


def merge_sql(spec, target: str, source: str, as_of: str = AS_OF) -> str:
    """MERGE result (with action) as a full outer join, mirroring the spec."""
    cols = list(spec.columns)
    stamp = f"TIMESTAMP '{as_of}'"
    tsel = ", ".join(f"{q(c)} AS {q('t_' + c)}" for c in cols + ["created_at", "updated_at"])
    ssel = ", ".join(f"{q(c)} AS {q('s_' + c)}" for c in cols)
    on = " AND ".join(f"{q('t_' + k)} = {q('s_' + k)}" for k in spec.keys)
    if spec.trigger is None:
        changed = "TRUE"
    else:
        changed = "coalesce(" + " OR ".join(
            f"{q('t_' + c)} <> {q('s_' + c)}" for c in spec.trigger) + ", FALSE)"
    action = (f"CASE WHEN t_hit AND s_hit AND {changed} THEN 'update' "
              f"WHEN t_hit AND s_hit THEN 'noop' WHEN s_hit THEN 'insert' ELSE 'keep' END")
    out = []
    for c in cols:
        if c in spec.keys or c not in spec.update_cols:
            out.append(f"CASE WHEN action = 'insert' THEN {q('s_' + c)} ELSE {q('t_' + c)} END AS {q(c)}")
        else:
            out.append(f"CASE WHEN action IN ('insert', 'update') THEN {q('s_' + c)} "
                       f"ELSE {q('t_' + c)} END AS {q(c)}")
    out.append(f"CASE WHEN action = 'insert' THEN {stamp} ELSE t_created_at END AS created_at")
    out.append(f"CASE WHEN action IN ('insert', 'update') THEN {stamp} ELSE t_updated_at END AS updated_at")
    out.append("action")
    return f"""WITH t AS (SELECT {tsel}, TRUE AS t_hit FROM ({target})),
s AS (SELECT {ssel}, TRUE AS s_hit FROM ({source})),
j AS (SELECT *, {action} AS action FROM t FULL OUTER JOIN s ON {on})
SELECT {", ".join(out)} FROM j"""


TARGET_WHERE = "ts < TIMESTAMP '2024-01-21 00:00:00'"
SOURCE_WHERE = "ts >= TIMESTAMP '2024-01-15 00:00:00'"

UPSERT_CHOKEPOINTS = merge_sql(SPECS["chokepoints"],
                               with_audit(chk_stats(TARGET_WHERE, SHIFTED_DAY)),
                               chk_stats(SOURCE_WHERE))
UPSERT_PORTS = merge_sql(SPECS["ports"],
                         with_audit(port_stats(TARGET_WHERE, SHIFTED_DAY)),
                         port_stats(SOURCE_WHERE))
UPSERT_MASTER = merge_sql(SPECS["master"], with_audit(master("s_nationkey < 15")),
                          master("s_nationkey >= 10"))
BACKFILL_SOURCE = (
    f"SELECT * FROM ({port_stats(UTC_DAY + ' BETWEEN DATE ' + chr(39) + '2024-01-10' + chr(39) + ' AND DATE ' + chr(39) + '2024-01-17' + chr(39))}) "
    f"UNION ALL SELECT * FROM ({port_stats(UTC_DAY + ' BETWEEN DATE ' + chr(39) + '2024-01-18' + chr(39) + ' AND DATE ' + chr(39) + '2024-01-25' + chr(39), drop=('export_roro',))})")
BACKFILL_PORTS = merge_sql(SPECS["ports"], with_audit(port_stats(TARGET_WHERE, SHIFTED_DAY)),
                           BACKFILL_SOURCE)

CHK_COLS = "portid, portname, n_tanker, n_container, n_dry_bulk, n_general_cargo, n_roro, n_cargo, n_total, capacity, event_date"

ORDER_STATS = """SELECT CAST(o_custkey AS VARCHAR) AS portid,
  'Chokepoint ' || CAST(o_custkey AS VARCHAR) AS portname,
  CAST(count_if(o_orderstatus = 'F') AS INTEGER) AS n_tanker,
  CAST(count_if(o_orderstatus = 'O') AS INTEGER) AS n_container,
  CAST(count_if(o_orderstatus = 'P') AS INTEGER) AS n_dry_bulk,
  CAST(count(*) AS INTEGER) AS n_total,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS capacity,
  CAST(o_orderdate AS DATE) AS event_date
FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)"""

# per-event records and their page position (request = UTC day, 100 a page)
EVENT_PAGES = f"""SELECT CAST(user_id AS VARCHAR) AS portid,
  'Chokepoint ' || CAST(user_id AS VARCHAR) AS portname,
  {", ".join(f"CAST({_is_kind(k)} AS BIGINT) AS n_{k}" for k in KINDS)},
  CAST(1 AS BIGINT) AS n_total, {CENTS} AS capacity, {UTC_DAY} AS event_date,
  (event_id - min(event_id) OVER (PARTITION BY {UTC_DAY})) // 100 AS page
FROM events"""
STAT_COLS = ("portid, portname, n_tanker, n_container, n_dry_bulk, n_general_cargo, "
             "n_roro, n_cargo, n_total, capacity, event_date")

ZONES_VALUES = "(VALUES " + ", ".join(
    f"({i}, {z[1]!r}::DOUBLE, {z[2]!r}::DOUBLE, {z[3]!r}::DOUBLE, {z[4]!r}::DOUBLE)"
    for i, z in enumerate(SHIPPED_ZONES)
) + ") AS z(zone_no, lat1, lon1, lat2, lon2)"

ZONE_POINTS = f"""SELECT e.*,
  z.lat1 + (z.lat2 - z.lat1) * CAST((event_id // 28) % 4 AS DOUBLE) * 0.5 AS latitude,
  (z.lon1 + z.lon2) / 2 AS longitude
FROM events e JOIN {ZONES_VALUES} ON e.event_id % 28 = z.zone_no"""

IN_ANY_ZONE = f"""EXISTS (SELECT 1 FROM {ZONES_VALUES.replace(' AS z(', ' AS zz(')}
  WHERE p.latitude BETWEEN least(zz.lat1, zz.lat2) AND greatest(zz.lat1, zz.lat2)
    AND p.longitude BETWEEN least(zz.lon1, zz.lon2) AND greatest(zz.lon1, zz.lon2))"""

MSG_TYPE = ("CASE event_type WHEN 'view' THEN 'PositionReport' "
            "WHEN 'click' THEN 'StandardClassBPositionReport' "
            "WHEN 'signup' THEN 'ShipStaticData' "
            "WHEN 'purchase' THEN 'SafetyBroadcastMessage' "
            "WHEN 'error' THEN 'DataLinkManagementMessage' END")

PARSED = f"""SELECT ts AS received, {MSG_TYPE} AS message_type, user_id AS mmsi,
  CASE WHEN user_id % 10 = 9 THEN '' ELSE 'VESSEL ' || CAST(user_id AS VARCHAR) END AS ship_name,
  latitude, longitude,
  CASE WHEN event_type <> 'signup' OR event_id % 13 = 0 THEN 'Unknown'
       WHEN event_id % 3 = 0 THEN 'PORT ' || CAST(user_id % 40 AS VARCHAR)
       WHEN event_id % 3 = 1 THEN NULL
       ELSE 'Unknown' END AS destination
FROM ({ZONE_POINTS})"""

VALID = f"SELECT * FROM ({PARSED}) WHERE mmsi IS NOT NULL AND mmsi <> 0"
IN_ZONE = f"SELECT * FROM ({VALID}) p WHERE {IN_ANY_ZONE}"
WITHIN_20_DAYS = "received <= TIMESTAMP '2024-01-21 00:00:00'"
AIS_SUMMARY = (f"SELECT count(*) AS total_messages, count(DISTINCT mmsi) AS unique_ships "
               f"FROM ({IN_ZONE}) WHERE {WITHIN_20_DAYS}")

DUP_COLS = ("portid, portname, n_tanker, n_container, n_dry_bulk, CAST(NULL AS INTEGER) AS n_general_cargo, "
            "CAST(NULL AS INTEGER) AS n_roro, CAST(NULL AS INTEGER) AS n_cargo, n_total, capacity, event_date")
UPSERT_DUPLICATES = f"""SELECT {DUP_COLS}, TIMESTAMP '{PRIOR_LOAD}' AS created_at,
  TIMESTAMP '{PRIOR_LOAD}' AS updated_at, 'keep' AS action
FROM ({ORDER_STATS}) WHERE event_date < DATE '1995-01-01'
UNION ALL
SELECT CAST(o_custkey AS VARCHAR) AS portid, 'Chokepoint ' || CAST(o_custkey AS VARCHAR) AS portname,
  CAST(o_orderstatus = 'F' AS INTEGER) AS n_tanker, CAST(o_orderstatus = 'O' AS INTEGER) AS n_container,
  CAST(o_orderstatus = 'P' AS INTEGER) AS n_dry_bulk, CAST(NULL AS INTEGER) AS n_general_cargo,
  CAST(NULL AS INTEGER) AS n_roro, CAST(NULL AS INTEGER) AS n_cargo, 1 AS n_total,
  CAST(round(o_totalprice * 100) AS BIGINT) AS capacity, CAST(o_orderdate AS DATE) AS event_date,
  TIMESTAMP '{AS_OF}' AS created_at, TIMESTAMP '{AS_OF}' AS updated_at, 'insert' AS action
FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01 00:00:00'"""

HOT_ROWS = """SELECT CASE WHEN o_custkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS portid, 'C' AS portname,
  1 AS n_tanker, 0 AS n_container, 0 AS n_dry_bulk, CAST(NULL AS INTEGER) AS n_general_cargo,
  CAST(NULL AS INTEGER) AS n_roro, CAST(NULL AS INTEGER) AS n_cargo, 1 AS n_total,
  CAST(CASE WHEN o_custkey % 10 = 0 THEN 0 ELSE year(o_orderdate) END AS BIGINT) AS capacity,
  CASE WHEN o_custkey % 10 = 0 THEN DATE '1995-01-01' ELSE CAST(date_trunc('year', o_orderdate) AS DATE) END AS event_date
FROM orders"""
UPSERT_HOT_TARGET = merge_sql(
    SPECS["chokepoints"], with_audit(f"SELECT * FROM ({HOT_ROWS}) WHERE event_date < DATE '1996-01-01'"),
    f"""SELECT * FROM ({HOT_ROWS}) WHERE portid IS NULL UNION ALL
    SELECT DISTINCT * REPLACE (capacity + CAST(portid AS BIGINT) % 2 AS capacity) FROM ({HOT_ROWS}) WHERE portid IS NOT NULL""")

ALL_ZONES = (SHIPPED_ZONES + [("Off " + z[0], z[1] - 1.0, z[2] - 1.0, z[3] + 1.0, z[4] + 1.0) for z in SHIPPED_ZONES]
             + [("East", -60.0, 90.0, 60.0, 180.0), ("Tropics", -23.5, -180.0, 23.5, 180.0)])
TAGGED = f"""SELECT p.*, t.zone FROM ({ZONE_POINTS}) p JOIN (VALUES {", ".join(
    f"('{z[0]}', {z[1]!r}::DOUBLE, {z[2]!r}::DOUBLE, {z[3]!r}::DOUBLE, {z[4]!r}::DOUBLE)" for z in ALL_ZONES)}) AS t(zone, a, b, c, d)
  ON p.latitude BETWEEN t.a AND t.c AND p.longitude BETWEEN t.b AND t.d"""

# windows of a day that the latest arrival less ten days has passed
CLOSED = f"""SELECT date_trunc('day', received)::TIMESTAMP AS window_start, date_trunc('day', received)::TIMESTAMP + INTERVAL 1 DAY AS window_end, count(*) AS n_messages
FROM ({IN_ZONE}) GROUP BY 1, 2 HAVING window_end <= (SELECT max(received) - INTERVAL 10 DAY FROM ({IN_ZONE}))"""

def days(first: str, last: str) -> str:
    return f"{UTC_DAY} BETWEEN DATE '{first}' AND DATE '{last}'"


def after_merge(spec, target: str, source: str, as_of: str) -> str:
    return f"SELECT * EXCLUDE (action) FROM ({merge_sql(spec, target, source, as_of)})"


FETCHED = with_audit(chk_stats(days('2024-01-01', '2024-01-11') + " AND event_id % 10 <> 0"), '2024-01-12 00:00:00')
FETCHED = after_merge(SPECS["chokepoints"], FETCHED, chk_stats(days('2024-01-09', '2024-01-19')), '2024-01-20 00:00:00')
FETCHED = after_merge(SPECS["chokepoints"], FETCHED, chk_stats(days('2024-01-18', '2024-01-31')), '2024-02-01 00:00:00')

NAMED = "CAST(portid AS BIGINT) % 23 <> 0 AND CAST(portid AS BIGINT) % 29 <> 0"


def named(where: str) -> str:
    return f"SELECT * FROM ({master(where)}) WHERE {NAMED}"


MASTER_JOB = " UNION ALL BY NAME ".join(
    f"SELECT *, '{table}' AS \"table\" FROM ({after_merge(SPECS['master'], with_audit(named(first)), named(then), AS_OF)})"
    for table, first, then in (("chokepoints_master", "s_nationkey < 3", "s_nationkey < 3"), ("ports_master", "s_nationkey < 15", "s_nationkey >= 10")))

NARROW_TARGET = f"SELECT {DUP_COLS} FROM ({ORDER_STATS})"
UPSERT_NARROW = merge_sql(SPECS["chokepoints"], with_audit(NARROW_TARGET), f"""
    SELECT * REPLACE (capacity + n_total % 2 AS capacity) FROM ({NARROW_TARGET}) WHERE date_trunc('month', event_date) = DATE '1997-06-01' UNION ALL
    SELECT * REPLACE (CAST(event_date + INTERVAL 120 MONTH AS DATE) AS event_date) FROM ({NARROW_TARGET}) WHERE CAST(portid AS BIGINT) <= 50""")

ORACLES = {
    "upsert_chokepoints": UPSERT_CHOKEPOINTS,
    "upsert_ports": UPSERT_PORTS,
    "upsert_master": UPSERT_MASTER,
    "upsert_duplicates": UPSERT_DUPLICATES,
    "upsert_dry_run": f"SELECT action, count(*) AS n_rows FROM ({UPSERT_CHOKEPOINTS}) GROUP BY action",
    "backfill_ports": BACKFILL_PORTS,
    "backfill_job": "SELECT * EXCLUDE (action) FROM (" + BACKFILL_PORTS + ")",
    "project_chokepoints": chk_stats(),
    "project_ports": port_stats(),
    "project_master": master(),
    "master_scan": named("TRUE") + " ORDER BY portname, portid",
    "page_corrupt": f"SELECT {STAT_COLS} FROM ({EVENT_PAGES}) WHERE page < 2",
    "stat_scan_mixed": f"""SELECT {STAT_COLS.replace('n_total', 'CASE WHEN place % 4 = 3 THEN NULL ELSE n_total END AS n_total')}
FROM ({EVENT_PAGES.replace('// 100 AS page', '// 100 AS page, event_id - min(event_id) OVER (PARTITION BY ' + UTC_DAY + ') AS place')})""",
    "chokepoint_scan": f"""SELECT {STAT_COLS} FROM ({EVENT_PAGES})
WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND portname IN ('Chokepoint 3', 'Chokepoint 17', 'Chokepoint 42')""",
    "chokepoint_job": f"""SELECT {STAT_COLS}, TIMESTAMP '{AS_OF}' AS created_at, TIMESTAMP '{AS_OF}' AS updated_at
FROM ({EVENT_PAGES}) WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
    "page_one": f"SELECT portid, event_date FROM ({port_stats()}) ORDER BY portid, event_date DESC LIMIT 100 OFFSET 1000",
    "upsert_hot_target": UPSERT_HOT_TARGET,
    "zone_wild": f"SELECT event_id, latitude, longitude FROM ({ZONE_POINTS}) p WHERE event_id % 97 > 2 AND {IN_ANY_ZONE}",
    "ais_summary_odd": f"""SELECT count(*) AS total_messages, count(DISTINCT user_id) AS unique_ships
FROM ({ZONE_POINTS}) p WHERE user_id <> 0 AND event_id % 50 <> 0 AND {IN_ANY_ZONE} AND ts <= TIMESTAMP '2024-01-21 00:00:00'""",
    "ais_bad_lines": "SELECT count(*) AS lines, count_if(event_id % 50 = 0) AS bad_lines FROM events",
    "traffic_job": AIS_SUMMARY,
    "epoch_to_date": """SELECT event_id,
  CASE WHEN event_id % 20 IN (0, 1) THEN NULL ELSE CAST(ts AS DATE) END AS event_date
FROM events""",
    "month_partition": f"""SELECT CAST(date_trunc('month', event_date) AS DATE) AS event_month,
  count(*) AS n_rows, CAST(sum(n_total) AS BIGINT) AS n_total,
  min(event_date) AS first_day, max(event_date) AS last_day
FROM ({ORDER_STATS}) GROUP BY 1""",
    "filter_range": f"SELECT * FROM ({port_stats()}) WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'",
    "filter_since": f"SELECT * FROM ({port_stats()}) WHERE event_date >= DATE '2024-01-25'",
    "filter_days": f"SELECT * FROM ({port_stats()}) WHERE event_date >= DATE '2024-01-24'",
    "filter_day": f"SELECT * FROM ({port_stats()}) WHERE event_date = DATE '2024-01-15'",
    "filter_ids": f"""SELECT * FROM ({chk_stats()})
WHERE portname IN ('Chokepoint 3', 'Chokepoint 17', 'Chokepoint 42', 'O''Brien Passage')""",
    "chokepoint_recent": f"SELECT * FROM ({chk_stats()}) WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
    "port_range": f"""SELECT * FROM ({port_stats()})
WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-12' AND portid IN ('1', '2', '3', '10', '100')""",
    "day_calendar": f"""SELECT CAST(d.day AS DATE) AS event_date, coalesce(c.n, 0) AS n_rows
FROM generate_series(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY) AS d(day)
LEFT JOIN (SELECT event_date, count(*) AS n FROM ({port_stats()}) GROUP BY event_date) c
  ON CAST(d.day AS DATE) = c.event_date""",
    "stat_scan": f"SELECT {STAT_COLS} FROM ({EVENT_PAGES})",
    "page_stop": f"""SELECT {STAT_COLS} FROM ({EVENT_PAGES})
WHERE NOT (page >= 2 AND (day(event_date) % 7 = 3 OR day(event_date) % 5 = 0))""",
    "page_slice": f"""SELECT portid, event_date,
  row_number() OVER (ORDER BY portid, event_date DESC) - 1 AS row_no,
  (row_number() OVER (ORDER BY portid, event_date DESC) - 1) // 1000 AS page_no
FROM ({port_stats()})""",
    "stat_order": f"SELECT portid, event_date, portcalls FROM ({port_stats()}) ORDER BY portid, event_date DESC",
    "stats_read": f"""SELECT *, TIMESTAMP '{PRIOR_LOAD}' AS created_at, TIMESTAMP '{PRIOR_LOAD}' AS updated_at
FROM ({ORDER_STATS}) WHERE event_date BETWEEN DATE '1995-03-15' AND DATE '1995-05-10'""",
    "sql_latest": f"""SELECT portid, event_date, n_total, TIMESTAMP '{PRIOR_LOAD}' + to_seconds(capacity % 86400) AS updated_at
FROM ({ORDER_STATS})
ORDER BY updated_at DESC, n_total DESC, portid ASC, event_date DESC LIMIT 5""",
    "latest_updates": f"""SELECT portid, event_date, n_total, updated_at, action FROM ({UPSERT_CHOKEPOINTS})
ORDER BY updated_at DESC, portid ASC, event_date DESC LIMIT 5""",
    "commit_message": f"""SELECT 'AIS ETL Pipeline' AS author,
  format('Upsert {{}} rows into {PORTS_TABLE} (Range: {{}} to {{}})', count(*), CAST(min(event_date) AS VARCHAR), CAST(max(event_date) AS VARCHAR)) AS message,
  '{PORTS_TABLE}' AS "table", count(*) AS row_count, min(event_date) AS min_date, max(event_date) AS max_date
FROM ({port_stats()})""",
    "zone_filter": f"SELECT event_id, latitude, longitude FROM ({ZONE_POINTS}) p WHERE {IN_ANY_ZONE}",
    "zone_filter_grid": f"SELECT event_id, latitude, longitude FROM ({ZONE_POINTS}) p WHERE {IN_ANY_ZONE}",
    "ais_parse": PARSED,
    "ais_positions": f"""SELECT received, message_type, mmsi, ship_name, latitude, longitude FROM ({IN_ZONE})
WHERE message_type IN ('PositionReport', 'StandardClassBPositionReport')""",
    "ais_statics": f"SELECT received, mmsi, ship_name, destination FROM ({IN_ZONE}) WHERE message_type = 'ShipStaticData'",
    "ais_duration": f"SELECT received, mmsi, message_type FROM ({VALID}) WHERE received <= TIMESTAMP '2024-01-16 00:00:00'",
    "ais_summary": AIS_SUMMARY,
    "ais_summary_stream": AIS_SUMMARY,
    "ais_distinct_stream": f"SELECT DISTINCT CAST(mmsi AS VARCHAR) AS ship_id FROM ({IN_ZONE})",
    "ais_counts_stream": f"SELECT *, CAST(sum(n_messages) OVER (ORDER BY window_start) AS BIGINT) AS running_messages FROM ({CLOSED})",
    "ais_running_job": f"""SELECT max(window_end) AS counted_until, CAST(sum(n_messages) AS BIGINT) AS total_messages,
  (SELECT count(DISTINCT mmsi) FROM ({IN_ZONE})) AS unique_ships FROM ({CLOSED})""",
    "ais_resume_stream": AIS_SUMMARY,
    "zone_traffic": f"SELECT zone, count(*) AS total_messages, count(DISTINCT user_id) AS unique_ships FROM ({TAGGED}) WHERE user_id <> 0 GROUP BY zone",
    "zone_tags": f"SELECT event_id, zone FROM ({TAGGED})",
    "incremental_job": FETCHED,
    "port_scan": f"""SELECT * FROM ({port_stats()})
WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-12' AND portid IN ('1', '2', '3', '10', '100')""",
    "master_job": MASTER_JOB,
    "project_master_text_key": f"SELECT * REPLACE (CASE WHEN CAST(portid AS BIGINT) % 19 = 0 THEN 'None' ELSE portid END AS portid) FROM ({master()})",
    "default_window_job": f"SELECT *, CAST(1 AS BIGINT) AS n_commits FROM ({with_audit(chk_stats(days('2024-01-22', '2024-02-01')), AS_OF)})",
    "stats_as_of": "SELECT * EXCLUDE (action) FROM (" + BACKFILL_PORTS + ")",
    "commit_changes": "SELECT *, CAST(1 AS BIGINT) AS n_rows FROM (" + BACKFILL_PORTS + ") WHERE action IN ('insert', 'update')",
    "upsert_narrow": UPSERT_NARROW,
    "page_seek": f"SELECT portid, event_date FROM ({port_stats()}) ORDER BY portid, event_date DESC LIMIT 100 OFFSET 1000",
    "stats_by_id": f"""SELECT *, TIMESTAMP '{PRIOR_LOAD}' AS created_at, TIMESTAMP '{PRIOR_LOAD}' AS updated_at
FROM ({ORDER_STATS}) WHERE event_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' AND portid IN ('1', '2', '77', '500', '1499')""",
    "commit_range": f"""SELECT 'AIS ETL Pipeline' AS author,
  format('Upsert {{}} rows into {PORTS_TABLE} (Range: {{}} to {{}})', count(*), CAST(min(event_date) AS VARCHAR), CAST(max(event_date) AS VARCHAR)) AS message,
  '{PORTS_TABLE}' AS "table", count(*) AS row_count, min(event_date) AS min_date, max(event_date) AS max_date
FROM ({after_merge(SPECS["ports"], "SELECT * EXCLUDE (action) FROM (" + BACKFILL_PORTS + ")", port_stats("ts >= TIMESTAMP '2024-01-20 00:00:00'"), '2024-02-05 00:00:00')})""",
}
