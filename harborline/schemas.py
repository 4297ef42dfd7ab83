"""Schemas of the statistics service pages, the four tables and the messages.

The field names and the dataset registry are fixed by the upstream statistics
service and by the table layout; they are stated once here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Field lists of the statistics service (one per dataset).
# ---------------------------------------------------------------------------
VESSEL_KINDS = ["tanker", "container", "dry_bulk", "general_cargo", "roro", "cargo"]

CHOKEPOINT_FIELDS = [
    "date", "portid", "portname", "n_tanker", "n_container", "n_dry_bulk",
    "n_general_cargo", "n_roro", "n_cargo", "n_total", "capacity",
]

PORT_FIELDS = (
    ["date", "portid", "portname", "country", "ISO3"]
    + [f"portcalls_{k}" for k in VESSEL_KINDS] + ["portcalls"]
    + [f"import_{k}" for k in VESSEL_KINDS] + ["import"]
    + [f"export_{k}" for k in VESSEL_KINDS] + ["export"]
)

MASTER_FIELDS = [
    "portid", "portname", "country", "ISO3", "continent", "fullname", "lat", "lon",
    "vessel_count_total", "vessel_count_container", "vessel_count_dry_bulk",
    "vessel_count_general_cargo", "vessel_count_RoRo", "vessel_count_tanker",
    "industry_top1", "industry_top2", "industry_top3",
    "share_country_maritime_import", "share_country_maritime_export",
    "LOCODE", "pageid", "countrynoaccents",
]

# Source name -> table name (Spark resolves names case-insensitively, so the
# projection renames explicitly).
RENAMES = {
    "date": "event_date",
    "ISO3": "iso3",
    "vessel_count_RoRo": "vessel_count_roro",
    "LOCODE": "locode",
}

AUDIT_COLUMNS = ["created_at", "updated_at"]


def _struct(pairs):
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


S, I, L, D, DT, TS = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                      T.DateType(), T.TimestampType())

# ---------------------------------------------------------------------------
# Raw attributes as delivered on a page. `date` is epoch milliseconds or text,
# so it is read as text and converted by functions.dates.event_date. Numbers are
# read as variants, whatever they arrive as, and cast once, in casts.strict,
# which fails on what is no number; the JSON reader would turn it into null.
# ---------------------------------------------------------------------------
CHOKEPOINT_ATTRS = _struct(
    [("date", S), ("portid", S), ("portname", S)]
    + [(f, T.VariantType()) for f in CHOKEPOINT_FIELDS[3:]]
)

PORT_ATTRS = _struct(
    [("date", S), ("portid", S), ("portname", S), ("country", S), ("ISO3", S)]
    + [(f, T.VariantType()) for f in PORT_FIELDS[5:]]
)

# Master values arrive as numbers or as text; a variant keeps which one it was,
# which the lenient cast needs (a number 12.7 becomes 12, the text "12.5" null).
MASTER_ATTRS = _struct([(f, T.VariantType()) for f in MASTER_FIELDS])

ERROR = _struct([("code", L), ("message", S)])


def page_schema(attrs: T.StructType) -> T.StructType:
    return _struct([
        ("features", T.ArrayType(_struct([("attributes", attrs)]))),
        ("exceededTransferLimit", T.BooleanType()),
        ("error", ERROR),
    ])


# ---------------------------------------------------------------------------
# Tables
# ---------------------------------------------------------------------------
CHOKEPOINTS = _struct(
    [("portid", S), ("portname", S)]
    + [(f, I) for f in CHOKEPOINT_FIELDS[3:10]]
    + [("capacity", L), ("event_date", DT)]
)

PORTS = _struct(
    [("portid", S), ("portname", S), ("country", S), ("iso3", S)]
    + [(f, I) for f in PORT_FIELDS[5:12]]
    + [(f, D) for f in PORT_FIELDS[12:]]
    + [("event_date", DT)]
)

MASTER = _struct(
    [("portid", S), ("portname", S), ("country", S), ("iso3", S), ("continent", S),
     ("fullname", S), ("lat", D), ("lon", D)]
    + [(f"vessel_count_{k}", L) for k in
       ["total", "container", "dry_bulk", "general_cargo", "roro", "tanker"]]
    + [("industry_top1", S), ("industry_top2", S), ("industry_top3", S),
       ("share_country_maritime_import", D), ("share_country_maritime_export", D),
       ("locode", S), ("pageid", S), ("countrynoaccents", S)]
)

COMMIT_LOG = _struct([
    ("author", S), ("message", S), ("table", S), ("row_count", L),
    ("min_date", DT), ("max_date", DT), ("committed_at", TS), ("snapshot", S),
    ("months", T.ArrayType(DT)), ("cursor", L),
])


@dataclass(frozen=True)
class Dataset:
    """One logical dataset of the statistics service."""

    name: str
    attrs: T.StructType
    table: T.StructType
    id_column: str            # column the id predicate applies to
    kind: str                 # "stat" or "master"


DATASETS = {
    "daily_chokepoint": Dataset("daily_chokepoint", CHOKEPOINT_ATTRS, CHOKEPOINTS, "portname", "stat"),
    "daily_port": Dataset("daily_port", PORT_ATTRS, PORTS, "portid", "stat"),
    "chokepoints_db": Dataset("chokepoints_db", MASTER_ATTRS, MASTER, "portid", "master"),
    "ports_db": Dataset("ports_db", MASTER_ATTRS, MASTER, "portid", "master"),
}
