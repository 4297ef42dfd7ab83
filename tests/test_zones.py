"""Zone files, point-in-rectangle semantics, the two join forms."""

import json
import os

from pyspark.sql import functions as F

from harborline.operators.spatial import in_any_zone
from harborline.sources.zones import (DEFAULT_ZONE, SHIPPED_ZONES, load_zones, read_zones_csv,
                                      read_zones_json, zones_frame)


def _write_forms(workdir):
    jp, cp = os.path.join(workdir, "zones.json"), os.path.join(workdir, "zones.bbox")
    with open(jp, "w") as f:
        json.dump([{"chokepoints": n, "bbox": [[a, b], [c, d]]} for n, a, b, c, d in SHIPPED_ZONES],
                  f, indent=2)
    with open(cp, "w") as f:
        for i, (n, a, b, c, d) in enumerate(SHIPPED_ZONES):
            note = " -> a note, with a comma" if i % 3 == 0 else (" - >other" if i % 3 == 1 else "")
            f.write(f"{b},{a},{d},{c}, {n}{note}\n")
    return jp, cp


def test_json_and_csv_forms_agree(spark, workdir):
    jp, cp = _write_forms(workdir)
    j = sorted(tuple(r) for r in read_zones_json(spark, jp).collect())
    c = sorted(tuple(r) for r in read_zones_csv(spark, cp).collect())
    assert len(j) == 28 and j == c
    assert all(r[1] < r[3] and r[2] < r[4] for r in j)


def test_fallbacks(spark, workdir):
    jp, _ = _write_forms(workdir)
    assert load_zones(spark, path=os.path.join(workdir, "missing.json")).collect()[0]["name"] == DEFAULT_ZONE[0]
    bad = os.path.join(workdir, "bad.json")
    with open(bad, "w") as f:
        f.write("{not json")
    assert load_zones(spark, path=bad).count() == 1
    assert load_zones(spark, zones=[], path=jp).count() == 28
    assert load_zones(spark, zones=[[[1, 2], [3, 4]]], path=jp).count() == 1


def _points(spark):
    return spark.createDataFrame(
        [(1, 25.9, 56.5), (2, 25.7969, 56.5), (3, 26.7969, 57.3598), (4, 27.0, 56.5),
         (5, 25.7969, 56.3598), (6, None, 56.5)],
        "id int, latitude double, longitude double")


def test_inside_edge_corner_outside(spark):
    z = zones_frame(spark, [DEFAULT_ZONE])
    got = sorted(r["id"] for r in in_any_zone(_points(spark), z).collect())
    assert got == [1, 2, 3, 5]


def test_overlapping_zones_match_once(spark):
    z = zones_frame(spark, [DEFAULT_ZONE, ("big", 20.0, 50.0, 30.0, 60.0)])
    got = sorted(r["id"] for r in in_any_zone(_points(spark), z).collect())
    assert got == [1, 2, 3, 4, 5]


def test_cells_equal_the_bounds(spark):
    pts = spark.range(0, 5000).select(
        F.col("id"), (F.rand(1) * 140 - 70).alias("latitude"), (F.rand(2) * 360 - 180).alias("longitude"))
    rects = [z[-4:] for z in SHIPPED_ZONES] + [(-10.0, -20.0, 10.0, 40.0), (-60.0, -170.0, -50.0, -169.5)]
    zones = zones_frame(spark, SHIPPED_ZONES + [("wide", -10.0, -20.0, 10.0, 40.0), ("thin", -60.0, -170.0, -50.0, -169.5)])
    want = sorted(r["id"] for r in pts.collect()
                  if any(min(a, c) <= r["latitude"] <= max(a, c) and min(b, d) <= r["longitude"] <= max(b, d) for a, b, c, d in rects))
    for fine_cells in (64, 0, 10**6):
        got = sorted(r["id"] for r in in_any_zone(pts, zones, fine_cells=fine_cells).collect())
        assert got == want and got


def test_wild_coordinates_are_in_no_zone(spark):
    pts = spark.createDataFrame([(1, 25.9, 56.5), (2, float("nan"), 56.5), (3, 1e12, 56.5), (4, None, 56.5), (5, 25.9, -1e300), (6, float("inf"), float("nan"))],
                                "id int, latitude double, longitude double")
    for n in (1, 300):
        zones = zones_frame(spark, [("z%d" % i, 25.0, 56.0, 26.0, 57.0 + i / 1000) for i in range(n)] + [("all", -90.0, -180.0, 90.0, 180.0)])
        assert [r["id"] for r in in_any_zone(pts, zones).collect()] == [1]


def test_tags_equal_the_bounds(spark):
    """Every pair of a point and a zone, once: overlapping zones, points on
    edges and cell corners, zones of both cell sizes, wild coordinates."""
    import random

    from harborline.operators.spatial import tag_zones
    from harborline.sources.zones import zones_frame

    rng = random.Random(4)
    zones = [(f"z{i}", *(rng.choice([-90.0, -30.0, 0.0, 1.0, 12.5, 30.0, 90.0]) for _ in range(4))) for i in range(40)]
    zones += [("same", 0.0, 0.0, 2.0, 2.0), ("same", 1.0, 1.0, 3.0, 3.0), ("dot", 5.0, 5.0, 5.0, 5.0)]
    at = [-90.0, -30.0, 0.0, 0.5, 1.0, 2.0, 5.0, 12.5, 30.0, 90.0, float("nan"), None, 1e9]
    points = [(i, a, o) for i, (a, o) in enumerate((a, o) for a in at for o in at)]
    frame = spark.createDataFrame(points, "id long, latitude double, longitude double")
    def inside(p, z):
        return all(v is not None and v == v and min(z[k], z[k + 2]) <= v <= max(z[k], z[k + 2]) and abs(v) <= (90 if k == 1 else 180) for k, v in ((1, p[1]), (2, p[2])))
    want = sorted({(p[0], z[0]) for p in points for z in zones if inside(p, z)})
    for fine_cells in (64, 0):
        got = tag_zones(frame, zones_frame(spark, zones), fine_cells=fine_cells)
        assert sorted((r["id"], r["zone"]) for r in got.collect()) == want
    import pytest
    with pytest.raises(ValueError):
        tag_zones(frame.withColumn("zone", frame["id"]), zones_frame(spark, zones))
