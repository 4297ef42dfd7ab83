"""Upsert semantics (one test per rule) on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from harborline.operators import merge
from harborline.operators.merge import SPECS, upsert
from harborline.schemas import CHOKEPOINTS, PORTS

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)
D1, D2 = dt.date(2024, 1, 5), dt.date(2024, 1, 6)


def chk(spark, rows, audit=True):
    cols = [f.name for f in CHOKEPOINTS.fields]
    full = []
    for r in rows:
        base = dict(zip(cols, [None] * len(cols)))
        base.update(r)
        vals = [base[c] for c in cols]
        full.append(tuple(vals) + ((T0, T0) if audit else ()))
    schema = CHOKEPOINTS.simpleString()[len("struct<"):-1]
    if audit:
        schema += ",created_at:timestamp,updated_at:timestamp"
    return spark.createDataFrame(full, schema.replace(":", " "))


def row(pid="1", day=D1, name="A", total=10, cap=100, tanker=1):
    return dict(portid=pid, event_date=day, portname=name, n_total=total, capacity=cap,
                n_tanker=tanker)


def run(spark, target, source, spec="chokepoints"):
    out = upsert(target, source, SPECS[spec], F.lit(AS_OF)).collect()
    return {(r["portid"], r["event_date"]): r for r in out}, out


def test_key_only_in_target_is_kept(spark):
    by, out = run(spark, chk(spark, [row("1"), row("2")]), chk(spark, [row("2")], audit=False))
    assert by[("1", D1)]["action"] == "keep"
    assert by[("1", D1)]["updated_at"] == T0
    assert len(out) == 2


def test_key_only_in_source_is_inserted_with_both_stamps(spark):
    by, _ = run(spark, chk(spark, [row("1")]), chk(spark, [row("9", D2)], audit=False))
    r = by[("9", D2)]
    assert r["action"] == "insert" and r["created_at"] == AS_OF and r["updated_at"] == AS_OF


def test_trigger_change_updates_but_keeps_name_and_created(spark):
    by, _ = run(spark, chk(spark, [row("1", total=10, tanker=1)]),
                chk(spark, [row("1", total=11, tanker=5, name="B")], audit=False))
    r = by[("1", D1)]
    assert r["action"] == "update"
    assert (r["n_total"], r["n_tanker"], r["portname"]) == (11, 5, "A")
    assert r["created_at"] == T0 and r["updated_at"] == AS_OF


def test_non_trigger_change_is_not_written(spark):
    by, _ = run(spark, chk(spark, [row("1", tanker=1)]), chk(spark, [row("1", tanker=7)], audit=False))
    r = by[("1", D1)]
    assert r["action"] == "noop" and r["n_tanker"] == 1 and r["updated_at"] == T0


def test_null_trigger_never_differs_but_other_trigger_still_fires(spark):
    by, _ = run(spark, chk(spark, [row("1", total=None, cap=100), row("2", total=None, cap=100)]),
                chk(spark, [row("1", total=5, cap=100), row("2", total=5, cap=200)], audit=False))
    assert by[("1", D1)]["action"] == "noop" and by[("1", D1)]["n_total"] is None
    assert by[("2", D1)]["action"] == "update" and by[("2", D1)]["n_total"] == 5


def _ports(spark, rows, audit=True):
    cols = [f.name for f in PORTS.fields]
    data = []
    for r in rows:
        base = dict(zip(cols, [None] * len(cols)))
        base.update(r)
        data.append(tuple(base[c] for c in cols) + ((T0, T0) if audit else ()))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in PORTS.fields)
    if audit:
        schema += ", created_at timestamp, updated_at timestamp"
    return spark.createDataFrame(data, schema)


def test_nan_equals_nan_and_nan_to_number_changes(spark):
    nan = float("nan")
    t = _ports(spark, [dict(portid="1", event_date=D1, portcalls=3, **{"import": nan, "export": 1.0}),
                       dict(portid="2", event_date=D1, portcalls=3, **{"import": nan, "export": 1.0})])
    s = _ports(spark, [dict(portid="1", event_date=D1, portcalls=3, **{"import": nan, "export": 1.0}),
                       dict(portid="2", event_date=D1, portcalls=3, **{"import": 5.0, "export": 1.0})],
               audit=False)
    by, _ = run(spark, t, s, "ports")
    assert by[("1", D1)]["action"] == "noop"
    assert by[("2", D1)]["action"] == "update"


def test_port_update_keeps_name_country_iso3(spark):
    t = _ports(spark, [dict(portid="1", event_date=D1, portname="P", country="C", iso3="X", portcalls=1)])
    s = _ports(spark, [dict(portid="1", event_date=D1, portname="Q", country="D", iso3="Y", portcalls=2)],
               audit=False)
    by, _ = run(spark, t, s, "ports")
    r = by[("1", D1)]
    assert (r["portname"], r["country"], r["iso3"], r["portcalls"]) == ("P", "C", "X", 2)


def test_null_key_inserts_every_run(spark):
    t = chk(spark, [row("1")])
    s = chk(spark, [row(None)], audit=False)
    _, out1 = run(spark, t, s)
    assert sorted(r["action"] for r in out1) == ["insert", "keep"]
    t2 = spark.createDataFrame([tuple(r)[:-1] for r in out1], t.schema)
    _, out2 = run(spark, t2, s)
    assert sum(r["portid"] is None for r in out2) == 2


def test_two_source_rows_on_one_target_row_fail(spark):
    t = chk(spark, [row("1")])
    s = chk(spark, [row("1", total=1), row("1", total=2)], audit=False)
    with pytest.raises(Exception, match="cardinality"):
        upsert(t, s, SPECS["chokepoints"], F.lit(AS_OF)).collect()


def test_two_source_rows_same_new_key_both_inserted(spark):
    _, out = run(spark, chk(spark, [row("1")]), chk(spark, [row("7"), row("7")], audit=False))
    assert sum(r["portid"] == "7" and r["action"] == "insert" for r in out) == 2


def test_same_source_twice_changes_nothing(spark):
    t = chk(spark, [row("1", total=1), row("3")])
    s = chk(spark, [row("1", total=2), row("2")], audit=False)
    _, out1 = run(spark, t, s)
    t2 = spark.createDataFrame([tuple(r)[:-1] for r in out1], t.schema)
    _, out2 = run(spark, t2, s)
    assert {r["action"] for r in out2} <= {"keep", "noop"}
    assert sorted(tuple(r)[:-1] for r in out1) == sorted(tuple(r)[:-1] for r in out2)


def test_master_rewrites_every_matched_row(spark):
    from harborline.schemas import MASTER
    cols = [f.name for f in MASTER.fields]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MASTER.fields)

    def mk(pid, name, audit):
        vals = {c: None for c in cols}
        vals.update(portid=pid, portname=name)
        return tuple(vals[c] for c in cols) + ((T0, T0) if audit else ())

    t = spark.createDataFrame([mk("1", "A", True)], schema + ", created_at timestamp, updated_at timestamp")
    s = spark.createDataFrame([mk("1", "A", False)], schema)
    out = upsert(t, s, SPECS["master"], F.lit(AS_OF)).collect()
    assert out[0]["action"] == "update" and out[0]["updated_at"] == AS_OF
    assert out[0]["created_at"] == T0


def test_row_count_is_target_plus_inserts(spark):
    t = chk(spark, [row(str(i)) for i in range(20)])
    s = chk(spark, [row(str(i), total=i) for i in range(10, 30)], audit=False)
    _, out = run(spark, t, s)
    assert len(out) == 20 + 10


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_has_no_full_outer_join(spark):
    t = chk(spark, [row(str(i)) for i in range(20)])
    s = chk(spark, [row(str(i), total=i) for i in range(10, 30)], audit=False)
    df = upsert(t, s, SPECS["chokepoints"], F.lit(AS_OF))
    df.collect()
    plan = _plan(df)
    assert "Window" not in plan and "FullOuter" not in plan
    assert "LeftOuter" in plan and "LeftAnti" in plan


def test_target_that_holds_a_key_many_times(spark):
    """As an earlier load leaves it that inserted duplicates; equal rows
    without a key on both sides."""
    t = chk(spark, [row("h", total=i % 3) for i in range(3000)] + [row("a"), row(None), row(None)])
    s = chk(spark, [row("h", total=1), row(None), row(None), row(None), row("n")], audit=False)
    out = upsert(t, s, SPECS["chokepoints"], F.lit(AS_OF))
    counts = {r["action"]: r["n"] for r in out.groupBy("action").agg(F.count("*").alias("n")).collect()}
    assert counts == {"update": 2000, "noop": 1000, "keep": 3, "insert": 4}


def test_hot_duplicate_key_is_inserted_outside_the_join(spark):
    hot = [row("h", total=i % 3) for i in range(3000)]
    t = chk(spark, [row(str(i)) for i in range(50)])
    s = chk(spark, hot + [row(str(i), total=i) for i in range(40, 100)], audit=False)
    out = upsert(t, s, SPECS["chokepoints"], F.lit(AS_OF))
    counts = {r["action"]: r["n"] for r in out.groupBy("action").agg(F.count("*").alias("n")).collect()}
    assert counts == {"keep": 40, "update": 10, "insert": 3000 + 50}
    with pytest.raises(Exception, match="cardinality"):
        t2 = chk(spark, [row("h")])
        upsert(t2, s, SPECS["chokepoints"], F.lit(AS_OF)).collect()


def test_narrow_upsert_equals_upsert(spark):
    """Also where the filter marks nearly all rows, and with null and repeated
    keys on both sides."""
    import random

    rng = random.Random(7)
    spec = merge.MergeSpec(keys=("k", "d"), columns=("k", "d", "v"), trigger=("v",), update_cols=("v",))
    stamp = dt.datetime(2024, 1, 1)
    day = lambda: rng.choice([None, dt.date(2024, 1, rng.randrange(1, 9))])
    target = [(rng.choice([None, f"p{rng.randrange(60)}"]), day(), rng.randrange(4), stamp, stamp) for _ in range(600)]
    keys = [(f"p{i}", dt.date(2024, 1, d)) for i in range(50, 70) for d in range(1, 9)]
    source = [(*k, rng.randrange(4)) for k in rng.sample(keys, 60)] + [(None, dt.date(2024, 1, 1), 1), ("p1", None, 2)]
    t = spark.createDataFrame(target, "k string, d date, v int, created_at timestamp, updated_at timestamp").repartition(3)
    s = spark.createDataFrame(source, "k string, d date, v int")
    at = F.lit(dt.datetime(2024, 2, 2))
    want = sorted(map(str, merge.upsert(t, s, spec, at).collect()))
    for bits in (6, 10, 24):
        assert sorted(map(str, merge.upsert_narrow(t, s, spec, at, bits).collect())) == want
    empty = s.where("false")
    assert {r["action"] for r in merge.upsert_narrow(t, empty, spec, at).collect()} == {"keep"}


def test_split_reads_the_target_once_and_does_not_shuffle_it(spark, workdir):
    import os

    path = os.path.join(workdir, "t")
    spark.range(1000).selectExpr("concat('p', id) AS k", "id AS v").write.parquet(path)
    spec = merge.MergeSpec(keys=("k",), columns=("k", "v"), trigger=("v",), update_cols=("v",))
    source = spark.createDataFrame([("p3", 9), ("q", 1)], "k string, v long")
    split = merge.split_target(spark.read.parquet(path), source, spec)
    rows = split.collect()
    plan = split._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "BroadcastHashJoin" in plan
    scan = plan[:plan.index("FileScan parquet")].rsplit("Broadcast", 1)[0]
    assert "Exchange hashpartitioning" not in scan and "rangepartitioning" not in plan
    assert {r["k"] for r in rows if r["_may"]} >= {"p3"} and sum(r["_may"] for r in rows) < 5
