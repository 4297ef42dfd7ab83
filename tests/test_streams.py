"""Message parsing and routing; stream result equals the batch result."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from harborline.plans import fixtures as fx
from harborline.sources.zones import zones_frame
from harborline.streaming import messages as M
from harborline.streaming import runner

T = dt.datetime(2024, 1, 1, 0, 0, 0)


def _msgs(spark, items):
    rows = [(T + dt.timedelta(seconds=s), v if isinstance(v, str) else json.dumps(v)) for s, v in items]
    return spark.createDataFrame(rows, "received timestamp_ntz, value string")


def _m(mtype, mmsi=123, name=" A \t", lat=26.0, lon=56.5, static=None, meta=True):
    d = {"MessageType": mtype}
    if meta:
        md = {"latitude": lat, "longitude": lon}
        if mmsi != "absent":
            md["MMSI"] = mmsi
        if name != "absent":
            md["ShipName"] = name
        d["MetaData"] = md
    d["Message"] = {} if static is None else {"ShipStaticData": static}
    return d


def test_parse_cases(spark):
    items = [(0, _m("PositionReport")), (1, _m("StandardClassBPositionReport", mmsi=None)),
             (2, _m("ShipStaticData", mmsi=0, static={"Destination": "X"})),
             (3, _m("ShipStaticData", name=None, static={"Destination": None})),
             (4, _m("ShipStaticData", name="absent", static={"Type": 7})),
             (5, _m("ShipStaticData")), (6, _m("Other", mmsi="absent")), (7, "{not json"),
             (8, _m("PositionReport", meta=False))]
    p = M.parse(_msgs(spark, items)).collect()
    assert [r["ship_name"] for r in p[:6]] == ["A", "A", "A", "", "", "A"]
    assert [r["destination"] for r in p[2:6]] == ["X", None, "Unknown", "Unknown"]
    assert p[7]["parsed_ok"] is False
    v = M.valid_ship(M.parse(_msgs(spark, items)))
    assert sorted(r["received"].second for r in v.collect()) == [0, 3, 4, 5]
    assert M.positions(v).count() == 1 and M.statics(v).count() == 3


def test_duration_boundary_is_inclusive(spark):
    items = [(0, _m("PositionReport")), (60, _m("PositionReport")), (61, _m("PositionReport"))]
    v = M.within_duration(M.parse(_msgs(spark, items)), T, 60)
    assert v.count() == 2


def test_summary_counts_distinct_vessels(spark):
    items = [(i, _m("PositionReport", mmsi=100 + i % 3)) for i in range(10)]
    r = M.summary(M.valid_ship(M.parse(_msgs(spark, items)))).collect()[0]
    assert (r["total_messages"], r["unique_ships"]) == (10, 3)


def _stream_summary(spark, msgs, root, split_col):
    landing = os.path.join(root, "landing")
    msgs.withColumn("part", split_col).write.partitionBy("part").parquet(landing)
    stream = runner.read_messages(spark, landing, recursiveFileLookup="true")
    flow = runner.traffic(stream, zones_frame(spark), "2024-01-01 00:00:00", 20 * 86400)
    runner.run_for(runner.start_sink(flow, os.path.join(root, "sinks")))
    return tuple(runner.traffic_summary(spark, os.path.join(root, "sinks")).collect()[0])


def test_stream_equals_batch_and_ignores_file_split(spark, workdir):
    msgs = fx.messages(fx.read(spark, "/root/testdata/sf0.001", "events"))
    batch = M.summary(runner.traffic(msgs, zones_frame(spark), "2024-01-01 00:00:00", 20 * 86400))
    b = tuple(batch.collect()[0])
    s1 = _stream_summary(spark, msgs, os.path.join(workdir, "a"), F.to_date("received"))
    s2 = _stream_summary(spark, msgs, os.path.join(workdir, "b"), F.hour("received") % 3)
    assert b == s1 == s2 and b[0] > 0


def test_live_run_stops_after_duration(spark, workdir):
    import time

    from harborline.plans import jobs
    msgs = fx.messages(fx.read(spark, "/root/testdata/sf0.001", "events"))
    landing = os.path.join(workdir, "landing")
    msgs.write.parquet(landing)
    t0 = time.time()
    got = jobs.traffic_summary(spark, landing, zones_frame(spark), os.path.join(workdir, "sinks"),
                               duration_sec=12, live=True).collect()[0]
    assert time.time() - t0 < 12 + 10
    batch = M.summary(runner.traffic(msgs, zones_frame(spark))).collect()[0]
    assert tuple(got) == tuple(batch)


def test_raw_message_lines_stream(spark, workdir):
    msgs = fx.messages(fx.read(spark, "/root/testdata/sf0.001", "events"))
    raw = os.path.join(workdir, "raw")
    msgs.select("value").write.text(raw)
    stream = runner.read_messages(spark, raw, fmt="text")
    flow = runner.traffic(stream, zones_frame(spark))
    runner.run_for(runner.start_sink(flow, os.path.join(workdir, "sinks")))
    got = tuple(runner.traffic_summary(spark, os.path.join(workdir, "sinks")).collect()[0])
    exp = tuple(M.summary(runner.traffic(msgs, zones_frame(spark))).collect()[0])
    assert got == exp


def test_odd_fields_do_not_cost_the_message(spark):
    lines = ['{"MessageType":"PositionReport","MetaData":{"MMSI":"3","latitude":"25.9","longitude":56.5}}',
             '{"MessageType":"PositionReport","MetaData":{"MMSI":4,"latitude":"x","longitude":null},"Message":"y"}',
             '{"MessageType":"ShipStaticData","MetaData":{"MMSI":"0"}}',
             '{"MetaData":{"MMSI":0}}', '{"MetaData":{"MMSI":""}}', '{"MetaData":{"MMSI":null}}', '{"MetaData":{"MMSI":false}}',
             '{"MetaData":"z"}', "[1]", '{"MetaData":{"MMSI":5', ""]
    p = M.parse(_msgs(spark, list(enumerate(lines))))
    v = M.valid_ship(p)
    assert sorted(r["ship_id"] for r in v.collect()) == ["0", "3", "4"]
    assert {r["ship_id"]: r["latitude"] for r in v.collect()} == {"0": None, "3": 25.9, "4": None}
    assert tuple(M.summary(v).first()) == (3, 3)
    assert tuple(M.bad_lines(p).first()) == (11, 3)


def test_sink_holds_each_kind(spark, workdir):
    msgs = fx.messages(fx.read(spark, "/root/testdata/sf0.001", "events"))
    landing = os.path.join(workdir, "landing")
    msgs.write.parquet(landing)
    flow = runner.traffic(runner.read_messages(spark, landing), zones_frame(spark))
    runner.run_for(runner.start_sink(flow, os.path.join(workdir, "sinks")))
    batch = runner.traffic(msgs, zones_frame(spark))
    for what, frame in (("positions", M.positions(batch)), ("statics", M.statics(batch))):
        got = runner.read_sink(spark, os.path.join(workdir, "sinks"), what)
        assert got.count() == frame.count() > 0 and got.exceptAll(frame).isEmpty()


def _land(spark, path, lo, hi, n=40):
    items = [(i, _m("PositionReport", mmsi=100 + i % 7 + (i // n) * 3)) for i in range(lo, hi)]
    _msgs(spark, items).coalesce(2).write.mode("append").parquet(path)


def test_running_figures_over_several_calls(spark, workdir):
    """Two calls over a growing landing give the figures of one over all of
    it; state holds a row a vessel, and a few windows."""
    from harborline.plans import jobs
    from harborline.streaming import running

    landing, root, once = (os.path.join(workdir, d) for d in ("l", "r", "o"))
    z = zones_frame(spark)
    _land(spark, landing, 0, 60)
    first = jobs.traffic_running(spark, landing, z, root, window="10 seconds", late="20 seconds").first()
    assert (first["total_messages"], first["unique_ships"]) == (30, 10)  # 59 s less 20 s: closed up to 30 s
    _land(spark, landing, 60, 200)
    second = jobs.traffic_running(spark, landing, z, root, window="10 seconds", late="20 seconds").first()
    whole = jobs.traffic_running(spark, landing, z, once, window="10 seconds", late="20 seconds").first()
    assert second == whole and second["counted_until"] == T + dt.timedelta(seconds=170) and second["total_messages"] == 170
    ships = running.start(running.ships(running.follow_sink(spark, once)), os.path.join(workdir, "again"), "ships")
    running.run_all([ships])
    n = running.state_size(ships)
    assert n["rows"] == second["unique_ships"] == running.read_ships(spark, root).count() and n["bytes"] > 0
    counts = running.read_counts(spark, root).orderBy("window_start").collect()
    assert [r["running_messages"] for r in counts] == [10 * (i + 1) for i in range(17)]


def test_live_running_job_stops_in_time(spark, workdir):
    from harborline.plans import jobs

    landing = os.path.join(workdir, "l")
    _land(spark, landing, 0, 100)
    got = jobs.traffic_running(spark, landing, zones_frame(spark), os.path.join(workdir, "r"), duration_sec=12, window="10 seconds", late="20 seconds").first()
    assert (got["total_messages"], got["unique_ships"]) == (70, 13)


def test_nothing_landed(spark, workdir):
    from harborline.plans import jobs

    landing = os.path.join(workdir, "l")
    _land(spark, landing, 0, 0)
    got = jobs.traffic_running(spark, landing, zones_frame(spark), os.path.join(workdir, "r")).first()
    assert (got["counted_until"], got["total_messages"], got["unique_ships"]) == (None, 0, 0)


def test_stop_and_resume(spark, workdir):
    """A run stopped after its first micro-batch and started again has the
    rows of one run, each once."""
    landing, root = os.path.join(workdir, "l"), os.path.join(workdir, "s")
    for i in range(5):
        _land(spark, landing, 20 * i, 20 * i + 20)
    def query(now):
        return runner.start_sink(runner.traffic(runner.read_messages(spark, landing, max_files_per_trigger=1), zones_frame(spark)), root, now)
    runner.run_batches(query(False), 1)
    before = runner.read_sink(spark, root).count()
    assert 0 < before < 100
    runner.run_for(query(True))
    got = runner.read_sink(spark, root)
    assert got.count() == got.select("received").distinct().count() == 100


def test_failure_is_raised_and_the_run_can_go_on(spark, workdir):
    """A landing file that cannot be read fails the run; with the file mended
    the next start has all rows once."""
    import pytest
    from pyspark.errors import StreamingQueryException

    landing, root = os.path.join(workdir, "l"), os.path.join(workdir, "s")
    _land(spark, landing, 0, 20)
    def query():
        return runner.start_sink(runner.traffic(runner.read_messages(spark, landing), zones_frame(spark)), root)
    runner.run_for(query())
    bad = os.path.join(landing, "part-bad.parquet")
    with open(bad, "wb") as f:
        f.write(b"PAR1 no parquet PAR1")
    with pytest.raises(StreamingQueryException):
        runner.run_for(query())
    _land(spark, os.path.join(workdir, "good"), 20, 40)
    good = next(f for f in os.listdir(os.path.join(workdir, "good")) if f.endswith(".parquet"))
    with open(bad, "wb") as f, open(os.path.join(workdir, "good", good), "rb") as g:
        f.write(g.read())
    runner.run_for(query())
    got = runner.read_sink(spark, root)
    n = 20 + spark.read.parquet(os.path.join(workdir, "good", good)).count()
    assert got.count() == got.select("received").distinct().count() == n
