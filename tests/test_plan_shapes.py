"""Guards on the physical plans that matter at scale (no regressions to a
shuffle of the big side, no lost pushdown)."""

import json
import os

from pyspark.sql import functions as F

from harborline.operators.spatial import in_any_zone
from harborline.plans import fixtures as fx
from harborline.sources import pages as pg
from harborline.sources.zones import SHIPPED_ZONES, zones_frame
from harborline.streaming import messages as M


def _plan(df):
    df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def _big_side_unshuffled(plan, scan):
    """No exchange between the join and the scan of the big input."""
    lines = plan.split("== Initial Plan ==")[0].splitlines()
    idx = [i for i, line in enumerate(lines) if scan in line]
    assert idx, plan
    for i in idx:
        depth = len(lines[i]) - len(lines[i].lstrip(" :+-|*()0123456789"))
        above = [line for line in lines[:i] if "Exchange" in line
                 and len(line) - len(line.lstrip(" :+-|*()0123456789")) < depth]
        if not any("hashpartitioning" in a or "rangepartitioning" in a for a in above):
            return True
    return False


def test_page_stop_does_not_shuffle_pages(spark, workdir):
    body = json.dumps({"features": [{"attributes": {"date": "1709251200000", "portid": "1"}}],
                       "exceededTransferLimit": False})
    text = spark.createDataFrame([("r", 0, body)], "request string, offset bigint, body string")
    log = os.path.join(workdir, "log")
    pg.page_log_lines(text).write.text(log)
    rows = pg.stat_rows(pg.read_page_log(spark, log, "daily_chokepoint"), "keep",
                        meta=pg.read_page_log_meta(spark, log))
    plan = _plan(rows)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("== Initial Plan ==")[0]
    assert _big_side_unshuffled(plan, "FileScan json")


def test_zone_joins_do_not_shuffle_points(spark):
    pts = fx.zone_points(fx.read(spark, "/root/testdata/sf0.001", "events")).select(
        "event_id", "latitude", "longitude")
    z = zones_frame(spark, SHIPPED_ZONES)
    for fine_cells in (64, 0):
        final = _plan(in_any_zone(pts, z, fine_cells=fine_cells)).split("== Initial Plan ==")[0]
        assert "BroadcastHashJoin" in final and "LeftOuter" in final
        assert "Exchange hashpartitioning" not in final and "NestedLoop" not in final


def test_message_parse_runs_once_and_duration_is_pushed(spark, workdir):
    msgs = fx.messages(fx.read(spark, "/root/testdata/sf0.001", "events"))
    path = os.path.join(workdir, "m")
    msgs.write.parquet(path)
    df = M.summary(M.within_duration(M.valid_ship(M.parse(spark.read.parquet(path))),
                                     "2024-01-01 00:00:00", 86400))
    plan = _plan(df).split("== Initial Plan ==")[0]
    assert plan.lower().count("parsejson") == 1, plan
    assert "LessThanOrEqual(received" in plan  # the cut reaches the Parquet scan


def test_stats_read_prunes_months(spark, workdir):
    from harborline.sources import tables
    o = fx.read(spark, "/root/testdata/sf0.001", "orders")
    rows = o.groupBy(F.col("o_custkey").cast("string").alias("portid"),
                     F.to_date("o_orderdate").alias("event_date")).agg(F.count("*").alias("n"))
    tables.write_months(rows, os.path.join(workdir, "t"))
    plan = _plan(tables.read_stats(spark, os.path.join(workdir, "t"), "1995-03-15", "1995-05-10"))
    assert "PartitionFilters: [isnotnull(event_month" in plan
    assert "GreaterThanOrEqual(event_date,1995-03-15)" in plan
