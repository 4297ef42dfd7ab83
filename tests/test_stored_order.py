"""Pages by seek, skipping by id, and date ranges from footers: same rows, and
what the scans read."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from harborline.plans import jobs
from harborline.sources import ordered, tables


@pytest.fixture()
def plain(spark):
    """Without adaptive plans, so that a plan's scans and metrics can be read."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def scans(df):
    """Files and rows that each scan of the plan read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    read = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return [tuple(m.get(k).get().value() for k in ("numFiles", "numOutputRows")) for m in read]


def test_pages_by_seek(plain, workdir):
    spark, path = plain, os.path.join(workdir, "t")
    rows = [(i * 37 % 1000, f"d{i % 7}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(5)
    ordered.write_ordered(df, path, [("b", False), ("a", True)], ranges=8)
    want = [(a, b, c) for a, b, c in sorted(rows, key=lambda r: (-int(r[1][1:]), r[0]))]
    assert ordered.n_rows(spark, path) == 1000
    for offset, size in [(0, 1), (0, 10), (333, 50), (990, 50), (0, 1000), (999, 1), (1000, 5), (5000, 5)]:
        assert [tuple(r) for r in ordered.read_page(spark, path, offset, size).collect()] == want[offset:offset + size]
    got = scans(ordered.read_page(spark, path, 333, 50))
    assert len(got) <= 2 and all(files == 1 for files, _ in got)
    index = spark.read.parquet(f"{path}/index").orderBy("start").collect()
    assert [r["start"] for r in index] == [sum(x["n"] for x in index[:i]) for i in range(len(index))]
    assert all((-int(r["first"]["b"][1:]), r["first"]["a"]) <= (-int(r["last"]["b"][1:]), r["last"]["a"]) for r in index)
    for bad in ((-1, 5), (0, 0)):
        with pytest.raises(ValueError):
            ordered.read_page(spark, path, *bad)
    with pytest.raises(ValueError):
        ordered.write_ordered(df.withColumn("_place", F.lit(1)), os.path.join(workdir, "u"), [("a", True)])


def test_pages_of_an_empty_table_and_of_ties(spark, workdir):
    empty = spark.createDataFrame([], "a int")
    ordered.write_ordered(empty, os.path.join(workdir, "e"), [("a", True)])
    assert ordered.n_rows(spark, os.path.join(workdir, "e")) == 0
    ties = spark.createDataFrame([(None,)] * 30 + [(1,)] * 30, "a int")
    ordered.write_ordered(ties, os.path.join(workdir, "t"), [("a", True)], ranges=4)
    got = [ordered.read_page(spark, os.path.join(workdir, "t"), i, 7).collect() for i in range(0, 60, 7)]
    assert [r["a"] for page in got for r in page] == [None] * 30 + [1] * 30


def stats(spark, ids=400, days=40):
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % days).cast("int"))
    rows = spark.range(ids * days).select(F.concat(F.lit("p"), F.lpad(F.floor(F.col("id") / days).cast("string"), 5, "0")).alias("portid"), day.alias("event_date"), F.lit(1).alias("n_total"))
    return rows.repartition(6)


def test_ids_skip_row_groups(plain, workdir):
    spark, path = plain, os.path.join(workdir, "t")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        tables.write_months(stats(spark), path, layout={"parquet.page.row.count.limit": "500", "parquet.block.size": "20000"})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    df = tables.read_stats(spark, path, "2024-01-01", "2024-01-31", ids=["p00007"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(portid,p00007)" in plan or "In(portid" in plan
    ((_, rows),) = scans(df)
    assert df.count() == 31 and rows < 400 * 31 / 4
    everything = tables.read_stats(spark, path, "2024-01-01", "2024-01-31")
    assert everything.count() == 400 * 31
    assert tables.read_stats(spark, path, ids=["p00003", "none"]).count() == 40


def test_months_are_clustered_by_id(spark, workdir):
    path = os.path.join(workdir, "t")
    tables.write_months(stats(spark), path)
    rows = spark.read.parquet(path).withColumn("f", F.input_file_name())
    per = rows.groupBy("event_month", "f").agg(F.min("portid").alias("lo"), F.max("portid").alias("hi")).orderBy("event_month", "lo").collect()
    for a, b in zip(per, per[1:]):
        assert a["event_month"] != b["event_month"] or a["hi"] <= b["lo"]


def test_date_range_from_footers(spark, workdir):
    path = os.path.join(workdir, "ports")
    tables.write_months(stats(spark), path)
    folders = [os.path.join(path, d) for d in os.listdir(path) if "=" in d]
    df = tables.date_bounds(spark, folders, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(event_date), MAX(event_date)]" in plan
    assert tuple(df.first()) == (16000, dt.date(2024, 1, 1), dt.date(2024, 2, 9))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert jobs.table_summary(spark, workdir, "ports").first()["row_count"] == 0  # nothing committed
