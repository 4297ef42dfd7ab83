"""Vessel messages: parsing and routing. Works on batch and streaming frames.

Input: `value` (the message JSON text) and `received` (arrival time).
Message shape read (everything else ignored):
  MessageType string
  MetaData {MMSI, ShipName, latitude, longitude}
  Message.ShipStaticData {... Destination ...}
A line is read as one variant, and each field is taken from it leniently, so
one field of an odd type (a coordinate or an id as text) costs that field at
most and never the message. An explicitly null Destination (kept null) can be
told from an absent one (default 'Unknown').
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.text import strip_ws

# Message types carrying a position, the static-data type and
# the destination used when a static message names none.
POSITION_TYPES = ["PositionReport", "StandardClassBPositionReport"]
STATIC_TYPE = "ShipStaticData"
UNKNOWN_DESTINATION = "Unknown"

def parse(df: DataFrame, value: str = "value", received: str = "received") -> DataFrame:
    """One typed row per input line; a line that is not a JSON object gets
    `parsed_ok` = false (counted by `bad_lines`, dropped by `valid_ship`).
    `ship_id` is the vessel id as text, null when it is missing, null, 0, false
    or empty; `mmsi` the same as a number, where it is one."""
    # The variant comes out of a one-row Generate: predicates on parsed fields
    # (valid id, zones, types) then stay above it instead of parsing again.
    parsed = df.select(F.col(received).alias("received"),
                       F.inline(F.array(F.struct(F.try_parse_json(F.col(value)).alias("v")))))
    field = lambda path, kind: F.try_variant_get(F.col("v"), path, kind)
    kind = F.coalesce(F.schema_of_variant("v"), F.lit(""))
    dest = F.try_variant_get(F.col("v"), "$.Message.ShipStaticData.Destination", "variant")
    ship, ship_type = field("$.MetaData.MMSI", "string"), F.schema_of_variant(field("$.MetaData.MMSI", "variant"))
    number = F.expr("try_variant_get(v, '$.MetaData.MMSI', 'double')")
    usable = F.when(ship_type == "STRING", ship != "").when(ship_type == "BOOLEAN", ship == "true").otherwise(
        ship_type.isNotNull() & (ship_type != "VOID") & ~F.coalesce(number == 0, F.lit(False)))
    return parsed.select(
        "received",
        kind.startswith("OBJECT").alias("parsed_ok"),
        field("$.MessageType", "string").alias("message_type"),
        field("$.MetaData.MMSI", "bigint").alias("mmsi"),
        strip_ws(field("$.MetaData.ShipName", "string")).alias("ship_name"),
        field("$.MetaData.latitude", "double").alias("latitude"),
        field("$.MetaData.longitude", "double").alias("longitude"),
        F.when(dest.isNull(), F.lit(UNKNOWN_DESTINATION)).otherwise(
            field("$.Message.ShipStaticData.Destination", "string")).alias("destination"),
        F.when(usable, ship).alias("ship_id"),
    )


def valid_ship(df: DataFrame) -> DataFrame:
    """Messages with a usable vessel id."""
    return df.where(F.col("parsed_ok") & F.col("ship_id").isNotNull())


def bad_lines(df: DataFrame) -> DataFrame:
    """Number of parsed lines, and of those that are no JSON object."""
    return df.agg(F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("parsed_ok")).alias("bad_lines"))


def within_duration(df: DataFrame, start, seconds: int) -> DataFrame:
    """Messages arriving no later than `seconds` after `start` (inclusive)."""
    if isinstance(start, str):
        start = _dt.datetime.fromisoformat(start)
    limit = start + _dt.timedelta(seconds=seconds)
    lit = F.expr(f"TIMESTAMP_NTZ '{limit.isoformat(sep=' ')}'") \
        if dict(df.dtypes).get("received") == "timestamp_ntz" else F.lit(limit)
    return df.where(F.col("received") <= lit)


def positions(df: DataFrame) -> DataFrame:
    return df.where(F.col("message_type").isin(POSITION_TYPES)).select(
        "received", "message_type", "mmsi", "ship_name", "latitude", "longitude")


def statics(df: DataFrame) -> DataFrame:
    return df.where(F.col("message_type") == STATIC_TYPE).select(
        "received", "mmsi", "ship_name", "destination")


def kind(df: DataFrame) -> Column:
    """What a message is: 'position', 'static' or 'other'."""
    return (F.when(F.col("message_type").isin(POSITION_TYPES), "position")
            .when(F.col("message_type") == STATIC_TYPE, "static").otherwise("other"))


def summary(df: DataFrame) -> DataFrame:
    """Total messages and exact number of distinct vessels (one row).

    count(DISTINCT) plans as a two-level aggregation: vessel ids are first
    de-duplicated map-side per partition, so a vessel sending a third of all
    messages adds one row per partition, not a third of the input, to the
    shuffle."""
    return df.agg(F.count(F.lit(1)).alias("total_messages"),
                  F.count_distinct("ship_id").alias("unique_ships"))


def zone_traffic(tagged: DataFrame, tag: str = "zone") -> DataFrame:
    """Messages and exact number of distinct vessels of each zone, from
    messages tagged by `spatial.tag_zones`. Vessels are de-duplicated map-side
    by (zone, vessel), so a busy zone does not gather its messages."""
    return tagged.groupBy(tag).agg(F.count(F.lit(1)).alias("total_messages"),
                                   F.count_distinct("ship_id").alias("unique_ships"))
