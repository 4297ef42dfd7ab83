"""Point-in-rectangle matching of messages against zones (closed rectangles).

One plan for every list of zones. Each rectangle is cut into grid cells, fine
ones (1 degree) or, where it touches more than FINE_CELLS of them, coarse ones
(30 degrees); a cell's rectangles are gathered into one row. A message gets its
two cells by flooring its coordinates and is joined with at most one row of
each cell table, then tested against their exact bounds, so it comes out at
most once. The cell tables are written first: Spark broadcasts them when their
real size is under its threshold, and AQE can split a busy cell on the message
side otherwise.

`tag_zones` is the one-to-many form: a row for each zone that a point lies in,
with the zone's name. A zone is cut into cells of one size only, and a point
lies in one cell of each size, so a pair comes out once, also on the edge of a
cell and where zones overlap.

Coordinates outside -90..90 / -180..180, NaN and null lie in no zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.session import materialize

FINE, COARSE = 1, 30
FINE_CELLS = 64


def _cell(value: Column, size: int, limit: int) -> Column:
    return F.when(value.between(F.lit(-float(limit)), F.lit(float(limit))), F.floor(value / size).cast("int"))


def zone_cells(zones: DataFrame, fine_cells: int = FINE_CELLS, named: bool = False) -> DataFrame:
    """One row per cell that a rectangle touches: its size, place, and the
    bounds (and names) of all rectangles that touch it."""
    fields = ["la", "ha", "lo", "ho"] + (["name"] if named else [])
    la, ha = F.greatest(F.least("lat1", "lat2"), F.lit(-90.0)), F.least(F.greatest("lat1", "lat2"), F.lit(90.0))
    lo, ho = F.greatest(F.least("lon1", "lon2"), F.lit(-180.0)), F.least(F.greatest("lon1", "lon2"), F.lit(180.0))
    z = zones.select(la.alias("la"), ha.alias("ha"), lo.alias("lo"), ho.alias("ho"), *(["name"] if named else [])).where("la <= ha AND lo <= ho")
    fine = (F.floor("ha") - F.floor("la") + 1) * (F.floor("ho") - F.floor("lo") + 1) <= fine_cells
    z = z.withColumn("size", F.when(fine, FINE).otherwise(COARSE))
    steps = lambda a, b: F.sequence(F.floor(F.col(a) / F.col("size")).cast("int"), F.floor(F.col(b) / F.col("size")).cast("int"))
    return (z.withColumn("cell_lat", F.explode(steps("la", "ha")))
            .withColumn("cell_lon", F.explode(steps("lo", "ho")))
            .groupBy("size", "cell_lat", "cell_lon")
            .agg(F.collect_list(F.struct(*fields)).alias("bounds")))


def _with_cells(points: DataFrame, cells: DataFrame, lat: str, lon: str) -> DataFrame:
    """`points` with the rectangles (`_fine`, `_coarse`) of their two cells."""
    p = points
    for name, size in (("_fine", FINE), ("_coarse", COARSE)):
        own = cells.where(F.col("size") == size).select(
            F.col("cell_lat").alias(f"{name}_lat"), F.col("cell_lon").alias(f"{name}_lon"), F.col("bounds").alias(name))
        at = [_cell(F.col(lat), size, 90) == F.col(f"{name}_lat"), _cell(F.col(lon), size, 180) == F.col(f"{name}_lon")]
        p = p.join(own, at, "left")
    return p


def _inside(lat: str, lon: str):
    return lambda z: F.col(lat).between(z["la"], z["ha"]) & F.col(lon).between(z["lo"], z["ho"])


def in_any_zone(points: DataFrame, zones: DataFrame, lat: str = "latitude",
                lon: str = "longitude", fine_cells: int = FINE_CELLS) -> DataFrame:
    """Rows of `points` lying in at least one zone (each row once).
    `fine_cells`: zones that touch more fine cells get coarse ones."""
    cells = materialize(zone_cells(zones, fine_cells), "zone-cells")
    hit = F.lit(False)
    for name in ("_fine", "_coarse"):
        hit = hit | F.coalesce(F.exists(name, _inside(lat, lon)), F.lit(False))
    return _with_cells(points, cells, lat, lon).where(hit).select(*points.columns)


def tag_zones(points: DataFrame, zones: DataFrame, lat: str = "latitude", lon: str = "longitude",
              fine_cells: int = FINE_CELLS, tag: str = "zone") -> DataFrame:
    """Rows of `points` with the name of a zone that they lie in, as `tag`: one
    row for each such name, none for points in no zone. Zones of one name are
    one zone; a zone without a name tags with null."""
    if tag in points.columns:
        raise ValueError(f"points have a column {tag}; choose another tag")
    cells = materialize(zone_cells(zones, fine_cells, named=True), "zone-names")
    found = [F.transform(F.filter(F.coalesce(F.col(c), F.array().cast(cells.schema["bounds"].dataType)), _inside(lat, lon)), lambda z: z["name"])
             for c in ("_fine", "_coarse")]
    names = F.array_distinct(F.concat(*found))
    return _with_cells(points, cells, lat, lon).select(*points.columns, F.explode(names).alias(tag))
