"""Load jobs on a scratch table root: writes, pruning, reruns, commit log."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from harborline.operators import commitlog
from harborline.plans import fixtures as fx
from harborline.plans import jobs
from harborline.sources import tables

SF = "/root/testdata/sf0.001"
AS_OF = dt.datetime(2024, 2, 1)


def _port_rows(spark, start, end):
    ev = fx.read(spark, SF, "events")
    return fx.port_stats(ev, fx.utc_day(ev)).where(F.col("event_date").between(start, end))


def test_backfill_then_rerun_changes_nothing(spark, workdir):
    src = _port_rows(spark, "2024-01-01", "2024-01-31")
    first = {r["action"]: r["n_rows"] for r in
             jobs.backfill_ports(spark, [src], workdir, "2024-01-01", "2024-01-31", as_of=AS_OF).collect()}
    n = src.count()
    assert first == {"insert": n}
    table = jobs.read_stats(spark, workdir, "ports")
    assert table.count() == n
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(f"{workdir}/ports") for f in fs)
    again = {r["action"]: r["n_rows"] for r in
             jobs.backfill_ports(spark, [src], workdir, "2024-01-01", "2024-01-31",
                                 as_of=dt.datetime(2024, 3, 1)).collect()}
    assert again == {"noop": n}
    assert files == sorted(os.path.join(d, f) for d, _, fs in os.walk(f"{workdir}/ports") for f in fs)
    assert jobs.read_stats(spark, workdir, "ports").where(F.col("updated_at") > AS_OF).count() == 0
    log = commitlog.read(spark, f"{workdir}/_commits").orderBy("committed_at").collect()
    assert len(log) == 2
    assert log[0]["message"].startswith(f"Upsert {n} rows into portwatch.ports (Range: 2024-01-01")


def test_dry_run_and_empty_source_write_nothing(spark, workdir):
    src = _port_rows(spark, "2024-01-01", "2024-01-10")
    counts = jobs.backfill_ports(spark, [src], workdir, "2024-01-01", "2024-01-10", dry_run=True)
    assert counts.collect()[0]["action"] == "insert"
    assert not os.path.exists(f"{workdir}/ports")
    empty = src.where(F.lit(False))
    assert jobs.backfill_ports(spark, [empty], workdir, "2024-01-01", "2024-01-10") is None
    assert not os.path.exists(f"{workdir}/_commits")


def test_month_pruning_in_plan(spark, workdir):
    o = fx.read(spark, SF, "orders")
    rows = (o.groupBy(F.col("o_custkey").cast("string").alias("portid"),
                      F.to_date("o_orderdate").alias("event_date"))
            .agg(F.count(F.lit(1)).cast("int").alias("n_total")))
    tables.write_months(fx.with_audit(rows), f"{workdir}/t")
    df = tables.read_stats(spark, f"{workdir}/t", "1995-03-15", "1995-05-10")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan
    assert df.select("event_month").distinct().count() == 3
    expected = rows.where(F.col("event_date").between("1995-03-15", "1995-05-10")).count()
    assert df.count() == expected


def test_master_load_snapshots(spark, workdir):
    m = fx.master_json(spark, SF).withColumn("request", F.lit("ports_db"))
    # all records on one page (the last one)
    body = m.groupBy("request").agg(F.concat(F.lit('{"features":['), F.array_join(
        F.collect_list(F.concat(F.lit('{"attributes":'), F.col("json"), F.lit("}"))), ","),
        F.lit('],"exceededTransferLimit":false}')).alias("body")).withColumn("offset", F.lit(0))
    from harborline.sources import pages as pg
    pages = pg.parse_pages(body, "ports_db")
    both = jobs.load_masters(spark, pages, pages, workdir, AS_OF, dry_run=True)
    assert {k: v.collect()[0]["action"] for k, v in both.items()} == {
        "chokepoints_master": "insert", "ports_master": "insert"}
    c1 = {r["action"]: r["n_rows"] for r in jobs.load_master(spark, pages, workdir, "ports_master", AS_OF).collect()}
    c2 = {r["action"]: r["n_rows"] for r in jobs.load_master(spark, pages, workdir, "ports_master").collect()}
    assert c1 == {"insert": 10} and c2 == {"update": 10}
    assert jobs.read_master(spark, workdir, "ports_master").count() == 10
    tables.register_views(spark, workdir, {"ports_master_v": ("ports_master", None, jobs.TABLES["ports_master"])})
    assert spark.sql("SELECT count(*) AS n FROM ports_master_v").first()["n"] == 10


def test_create_stats_then_load(spark, workdir):
    from harborline.schemas import PORTS
    tables.create_stats(spark, f"{workdir}/ports", PORTS)
    assert tables.read_stats(spark, f"{workdir}/ports", schema=PORTS).count() == 0
    src = _port_rows(spark, "2024-01-30", "2024-01-31")
    jobs.backfill_ports(spark, [src], workdir, "2024-01-30", "2024-01-31", as_of=AS_OF)
    assert jobs.read_stats(spark, workdir, "ports").count() == src.count()


def test_partial_month_update_keeps_other_rows(spark, workdir):
    a = _port_rows(spark, "2024-01-01", "2024-01-20")
    jobs.backfill_ports(spark, [a], workdir, "2024-01-01", "2024-01-20", as_of=AS_OF)
    b = _port_rows(spark, "2024-01-15", "2024-01-31").withColumn("portcalls", F.col("portcalls") + 1)
    counts = {r["action"]: r["n_rows"] for r in
              jobs.backfill_ports(spark, [b], workdir, "2024-01-15", "2024-01-31", as_of=AS_OF).collect()}
    t = jobs.read_stats(spark, workdir, "ports")
    assert t.count() == a.unionByName(b).select("portid", "event_date").distinct().count()
    assert counts["keep"] == a.where(F.col("event_date") < "2024-01-15").count()
    assert t.where((F.col("event_date") < "2024-01-15") & (F.col("updated_at") > AS_OF)).count() == 0


def test_chokepoint_job_from_page_files(spark, workdir):
    import json
    pages_root = os.path.join(workdir, "pages")
    kinds = {f"n_{k}": 1 for k in ("tanker", "container", "dry_bulk", "general_cargo", "roro", "cargo")}
    recs = [{"attributes": {"date": 1705276800000 + 86400000 * d, "portid": str(p),
                            "portname": f"C{p}", **kinds, "n_total": p + d, "capacity": 10 * p}}
            for d in range(3) for p in range(4)]
    for i in range(0, len(recs), 5):
        d = os.path.join(pages_root, "request=q1", f"offset={i}")
        os.makedirs(d)
        with open(os.path.join(d, "page.json"), "w") as f:
            json.dump({"features": recs[i:i + 5], "exceededTransferLimit": i + 5 < len(recs)}, f)
    from harborline.sources import pages as pg
    pages = pg.read_pages(spark, pages_root, "daily_chokepoint")
    counts = {r["action"]: r["n_rows"] for r in jobs.upsert_chokepoints(
        spark, pages, workdir, "2024-01-15", "2024-01-16", now="2024-01-31", as_of=AS_OF).collect()}
    assert counts == {"insert": 8}
    t = jobs.read_stats(spark, workdir, "chokepoints")
    assert sorted(str(r[0]) for r in t.select("event_date").distinct().collect()) == ["2024-01-15", "2024-01-16"]


def test_traffic_summary_job(spark, workdir):
    from harborline.sources.zones import zones_frame
    msgs = fx.messages(fx.read(spark, SF, "events"))
    landing = os.path.join(workdir, "landing")
    msgs.write.parquet(landing)
    got = jobs.traffic_summary(spark, landing, zones_frame(spark), os.path.join(workdir, "sinks"),
                               duration_sec=20 * 86400, start="2024-01-01 00:00:00").collect()[0]
    assert got["total_messages"] > 0 and got["unique_ships"] > 0
    from harborline.streaming import runner
    assert runner.read_sink(spark, os.path.join(workdir, "sinks"), "positions").count() > 0


def test_recreate_and_sql_views(spark, workdir):
    from harborline.schemas import PORTS
    src = _port_rows(spark, "2024-01-01", "2024-01-31")
    jobs.backfill_ports(spark, [src], workdir, "2024-01-01", "2024-01-31", as_of=AS_OF)
    jobs.register_views(spark, workdir, {"ports_v": "ports"})
    top = spark.sql("SELECT portid, updated_at FROM ports_v ORDER BY updated_at DESC, portid LIMIT 5").collect()
    assert len(top) == 5 and top[0]["updated_at"] == AS_OF
    path = f"{workdir}/plain"
    tables.write_months(jobs.read_stats(spark, workdir, "ports"), path)
    assert tables.read_stats(spark, path, schema=PORTS).count() == src.count()
    tables.create_stats(spark, path, PORTS, recreate=True)
    assert tables.read_stats(spark, path, schema=PORTS).count() == 0


def test_load_that_stops_before_its_commit(spark, workdir, monkeypatch):
    a = _port_rows(spark, "2024-01-01", "2024-01-20")
    jobs.backfill_ports(spark, [a], workdir, "2024-01-01", "2024-01-20", as_of=AS_OF)
    before = sorted(map(repr, jobs.read_stats(spark, workdir, "ports").collect()))
    b = _port_rows(spark, "2024-01-15", "2024-01-31").withColumn("portcalls", F.col("portcalls") + 1)
    load = lambda: jobs.backfill_ports(spark, [b], workdir, "2024-01-15", "2024-01-31", as_of=AS_OF)

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(commitlog, "append", stop)
        with pytest.raises(RuntimeError):
            load()
    assert sorted(map(repr, jobs.read_stats(spark, workdir, "ports").collect())) == before
    counts = {r["action"]: r["n_rows"] for r in load().collect()}
    assert counts["insert"] > 0 and counts["update"] > 0
    assert jobs.read_stats(spark, workdir, "ports").count() == a.unionByName(b).select("portid", "event_date").distinct().count()


def test_newest_load_counts_whatever_its_stamp(spark, workdir):
    from harborline.sources import pages as pg

    def load(name, as_of):
        body = '{"features":[{"attributes":{"portid":"1","portname":"%s"}}],"exceededTransferLimit":false}' % name
        jobs.load_master(spark, pg.parse_pages(spark.createDataFrame([("m", 0, body)], "request string, offset bigint, body string"), "ports_db"),
                         workdir, "ports_master", as_of)
        tables.register_views(spark, workdir, {"m_v": ("ports_master", None, jobs.TABLES["ports_master"])})
        got = [r["portname"] for r in jobs.read_master(spark, workdir, "ports_master").collect()]
        assert got == [r["portname"] for r in spark.sql("SELECT portname FROM m_v").collect()] == [name]

    load("first", AS_OF)
    load("second", AS_OF)
    load("third", dt.datetime(2023, 1, 1))


def test_a_load_leaves_no_scratch_and_few_files(spark, workdir):
    from harborline.session import scratch_root

    def loads():
        folder = os.path.join(scratch_root(spark).removeprefix("file:"), "harborline")
        return {x for x in (os.listdir(folder) if os.path.isdir(folder) else []) if x.startswith("load-")}

    before = loads()
    src = _port_rows(spark, "2024-01-01", "2024-01-31").repartition(40)
    jobs.backfill_ports(spark, [src], workdir, "2024-01-01", "2024-01-31", as_of=AS_OF)
    assert loads() == before
    files = [f for _, _, fs in os.walk(f"{workdir}/ports") for f in fs if f.endswith(".parquet")]
    assert len(files) <= 2
