"""Loads of what is new: unseen files once, one parse, cursors, commits."""

import datetime as dt
import json
import os
import random
from collections import Counter

import pytest

from harborline.operators import commitlog, merge
from harborline.plans import fixtures as fx
from harborline.plans import jobs
from harborline.sources import landing
from harborline.sources import pages as pg
from harborline.sources import tables
from harborline.schemas import CHOKEPOINTS

KEYS = ("portid", "event_date")


def line(request, offset, rows, more=False, **extra):
    attributes = [{"date": d, "portid": p, "portname": f"C{p}", "n_total": n, "capacity": n} for d, p, n in rows]
    return json.dumps({"request": request, "offset": offset, "response": {"features": [{"attributes": a} for a in attributes], "exceededTransferLimit": more, **extra}})


def land(root, day, name, lines):
    folder = os.path.join(root, "daily_chokepoint", f"fetch_day={day}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture()
def paths(workdir):
    return [os.path.join(workdir, d) for d in ("landing", "stage", "tables")]


def load(spark, paths, **kw):
    return jobs.load_new_chokepoints(spark, *paths, "2024-01-01", "2024-01-31", now="2024-01-31", **kw)


def stored(spark, paths):
    return sorted((r["portid"], str(r["event_date"]), r["n_total"]) for r in jobs.read_stats(spark, paths[2], "chokepoints").collect())


def test_only_unseen_files_are_read(spark, paths):
    land(paths[0], "2024-01-02", "a", [line("r1", 0, [("2024-01-01", "1", 5)])])
    assert landing.ingest(spark, *paths[:2], "daily_chokepoint") == 1
    assert landing.ingest(spark, *paths[:2], "daily_chokepoint") == 0
    land(paths[0], "2024-01-02", "b", [line("r2", 0, [("2024-01-01", "2", 6)]), line("r3", 0, [("2024-01-02", "2", 7)])])
    assert landing.ingest(spark, *paths[:2], "daily_chokepoint") == 2
    assert landing.read_stage(spark, paths[1], "daily_chokepoint").count() == 3


def test_loads_equal_one_full_load(spark, paths, workdir):
    rng = random.Random(1)
    for day in range(3, 7):
        rows = [(f"2024-01-{d:02d}", str(p), rng.randrange(9)) for d in (day - 2, day - 1, day) for p in range(5)]
        land(paths[0], f"2024-01-{day:02d}", "a", [line(f"r{day}", 0, rows[:8], True), line(f"r{day}", 8, rows[8:])])
        load(spark, paths, as_of=dt.datetime(2024, 1, day))
    got = stored(spark, paths)
    assert len(got) == 30
    # from the same stage, a fetch day at a time, without cursors
    other = os.path.join(workdir, "other")
    for day in range(3, 7):
        pages = landing.read_stage(spark, paths[1], "daily_chokepoint", fetched=(f"2024-01-{day:02d}", f"2024-01-{day:02d}"))
        jobs.upsert_chokepoints(spark, pages, other, "2024-01-01", "2024-01-31", now="2024-01-31", as_of=dt.datetime(2024, 1, day))
    same = lambda root: sorted(map(str, jobs.read_stats(spark, root, "chokepoints").collect()))
    assert same(paths[2]) == same(other)
    assert load(spark, paths) is None  # nothing new


def test_a_load_that_fails_keeps_the_cursor(spark, paths):
    """A request whose end has not landed fails the load; when it has, the
    next load takes all of the request."""
    land(paths[0], "2024-01-02", "a", [line("r1", 0, [("2024-01-01", "1", 5)], more=True)])
    with pytest.raises(Exception, match="no last page of r1"):
        load(spark, paths)
    land(paths[0], "2024-01-03", "b", [line("r1", 1, [("2024-01-01", "2", 6)])])
    assert load(spark, paths).first()["n_rows"] == 2
    land(paths[0], "2024-01-03", "c", ['{"request": "r2", "off'])
    with pytest.raises(Exception, match="unreadable page"):
        load(spark, paths)
    assert len(stored(spark, paths)) == 2 and jobs.commits(spark, paths[2], "chokepoints").count() == 1


def test_a_dry_run_leaves_the_cursor(spark, paths):
    land(paths[0], "2024-01-02", "a", [line("r1", 0, [("2024-01-01", "1", 5)])])
    assert load(spark, paths, dry_run=True).first()["n_rows"] == 1
    assert load(spark, paths).first()["n_rows"] == 1


def test_plans(spark, paths):
    """Cursor and fetch days are partition predicates; the heads are read
    without the features; a line is parsed once."""
    land(paths[0], "2024-01-02", "a", [line("r1", 0, [("2024-01-01", "1", 5)])])
    landing.ingest(spark, *paths[:2], "daily_chokepoint")
    pages = landing.read_stage(spark, paths[1], "daily_chokepoint", after=5, fetched=("2024-01-01", None))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    text = plan(pages)
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "ingest" in filters and "fetch_day" in filters
    from harborline.operators import paging
    heads = plan(pages.select("request", "offset", paging.n_features(pages), paging.stop_flag(pages)))
    assert "features" not in heads.split("ReadSchema: ")[1].replace("n_features", "")
    lines = spark.createDataFrame([(line("r", 0, []),)], "value string")
    parsed = plan(pg.stat_rows(landing.parse_log_lines(lines, "daily_chokepoint").where("offset >= 0"), "keep"))
    assert parsed.split("== Initial Plan ==")[0].count("from_json") == 1


# ------------------------------------------------------------------ commits
def rows(spark, items):
    return spark.createDataFrame([(p, f"C{p}", n, dt.date(2024, m, 1)) for p, m, n in items], "portid string, portname string, n_total int, event_date date")


def typed(spark, items):
    df = rows(spark, items)
    for f in CHOKEPOINTS.fields:
        if f.name not in df.columns:
            df = df.selectExpr("*", f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}")
    return df.select(*[f.name for f in CHOKEPOINTS.fields])


def three_loads(spark, root):
    loads = [[("1", 1, 1), ("2", 1, 1), ("1", 2, 1)], [("1", 1, 2), ("3", 1, 1)], [("1", 2, 5), ("1", 3, 5)]]
    for i, items in enumerate(loads):
        jobs.load_stats(spark, typed(spark, items), root, "chokepoints", as_of=dt.datetime(2024, 5, i + 1))
    return [r["snapshot"] for r in jobs.commits(spark, root, "chokepoints").collect()]


def state(spark, root, **at):
    return sorted((r["portid"], r["event_date"].month, r["n_total"]) for r in jobs.read_stats(spark, root, "chokepoints", **at).collect())


STATES = [[("1", 1, 1), ("1", 2, 1), ("2", 1, 1)], [("1", 1, 2), ("1", 2, 1), ("2", 1, 1), ("3", 1, 1)],
          [("1", 1, 2), ("1", 2, 5), ("1", 3, 5), ("2", 1, 1), ("3", 1, 1)]]


def test_every_state_can_be_read(spark, workdir):
    snapshots = three_loads(spark, workdir)
    for i, s in enumerate(snapshots):
        assert state(spark, workdir, commit=s) == STATES[i]
        assert state(spark, workdir, time=dt.datetime(2024, 5, i + 1, 12)) == STATES[i]
    assert state(spark, workdir) == STATES[2] and state(spark, workdir, time=dt.datetime(2024, 4, 1)) == []
    with pytest.raises(ValueError):
        state(spark, workdir, commit="20200101")
    with pytest.raises(ValueError):
        jobs.commit_changes(spark, workdir, "ports", snapshots[0])


def test_what_a_commit_changed(spark, workdir):
    snapshots = three_loads(spark, workdir)
    changed = [sorted((r["action"], r["portid"], r["event_date"].month, r["n_total"]) for r in jobs.commit_changes(spark, workdir, "chokepoints", s).collect()) for s in snapshots]
    assert changed[0] == [("insert", *r) for r in STATES[0]]
    assert changed[1] == [("insert", "3", 1, 1), ("update", "1", 1, 2), ("was", "1", 1, 1)]
    assert changed[2] == [("insert", "1", 3, 5), ("update", "1", 2, 5), ("was", "1", 2, 1)]


def test_difference_rebuilds_after_from_before(spark):
    rng = random.Random(2)
    make = lambda: [(rng.choice(["1", "2", None, "3"]), rng.randrange(1, 4), rng.randrange(2)) for _ in range(30)]
    before, after = make(), make()
    got = merge.difference(rows(spark, before), rows(spark, after), KEYS).collect()
    count = Counter(before)
    for r in got:
        count[r["portid"], r["event_date"].month, r["n_total"]] += r["n_rows"] * (1 if r["action"] in ("insert", "update") else -1)
    assert +count == Counter(after) and min(count.values()) >= 0
    key = lambda r: (r["portid"], r["event_date"])
    gone = {key(r) for r in got if r["action"] in ("was", "delete")}
    for r in got:
        if r["action"] in ("insert", "update"):
            assert (r["action"] == "update") == (r["portid"] is not None and key(r) in gone)


def test_replaced_folders_are_removed(spark, workdir):
    snapshots = three_loads(spark, workdir)
    jan, feb = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    assert jobs.remove_replaced(spark, workdir, "chokepoints", dt.datetime(2024, 5, 1, 12)) == []
    assert jobs.remove_replaced(spark, workdir, "chokepoints", dt.datetime(2024, 5, 2, 12)) == [(jan, snapshots[0])]
    assert state(spark, workdir, commit=snapshots[1]) == STATES[1] and state(spark, workdir) == STATES[2]
    assert jobs.remove_replaced(spark, workdir, "chokepoints", dt.datetime(2024, 6, 1)) == [(jan, snapshots[0]), (feb, snapshots[0])]
    assert state(spark, workdir) == STATES[2]
    assert tables.read_loads(spark, f"{workdir}/chokepoints", commitlog.current_months(spark, f"{workdir}/_commits", jobs.TABLES["chokepoints"]), CHOKEPOINTS).count() == 5


def test_log_is_compacted(spark, workdir, monkeypatch):
    """States and cursors are those of the log; a stop before the gathered
    files are deleted counts nothing twice, one before the gathering is whole
    loses nothing."""
    monkeypatch.setattr(commitlog, "COMPACT_AFTER", 2)
    snapshots = three_loads(spark, workdir)
    log = f"{workdir}/_commits"
    files = lambda: sorted(f for f in os.listdir(log) if f.endswith(".parquet"))
    assert len(files()) == 1 and len(os.listdir(f"{log}/{commitlog.GATHERED}")) == 1
    rows = sorted(map(str, commitlog.read(spark, log).collect()))
    assert len(rows) == 3 and [state(spark, workdir, commit=s) for s in snapshots] == STATES
    whole = os.listdir(f"{log}/{commitlog.GATHERED}")[0]
    os.makedirs(f"{log}/{commitlog.GATHERED}/99990101T000000000000")  # begun, not whole
    assert sorted(map(str, commitlog.read(spark, log).collect())) == rows
    # the files that were gathered are still there
    gathered = spark.read.parquet(f"{log}/{commitlog.GATHERED}/{whole}")
    name = gathered.first()[commitlog.FILE]
    with open(f"{log}/{files()[0]}", "rb") as f, open(f"{log}/{name}", "wb") as g:
        g.write(f.read())
    assert sorted(map(str, commitlog.read(spark, log).collect())) == rows
    commitlog.compact(spark, log)
    assert files() == [] and sorted(map(str, commitlog.read(spark, log).collect())) == rows
    commitlog.compact(spark, log)
    assert sorted(map(str, commitlog.read(spark, log).collect())) == rows
