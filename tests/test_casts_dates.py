"""Strict and lenient projections, raw date conversion, calendars, windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from harborline.functions.casts import lenient, strict
from harborline.functions.dates import calendar, event_date, month_list
from harborline.functions.text import strip_ws
from harborline.operators import predicates
from harborline.schemas import CHOKEPOINTS, MASTER, MASTER_ATTRS


def test_event_date_forms(spark):
    df = spark.createDataFrame(
        [(None,), ("0",), ("",), ("1709251200000",), ("1709337599999",), ("2024-03-05",),
         ("1709251200000.0",)], "d string")
    got = [r[0] for r in df.select(event_date("d")).collect()]
    assert got == [None, None, None, dt.date(2024, 3, 1), dt.date(2024, 3, 1),
                   dt.date(2024, 3, 5), dt.date(2024, 3, 1)]


def test_event_date_bad_text_fails(spark):
    df = spark.createDataFrame([("not a date",)], "d string")
    with pytest.raises(Exception):
        df.select(event_date("d")).collect()


def test_strict_casts_and_overflow_fails(spark):
    raw = spark.createDataFrame([("1", "A", 5, 7, dt.date(2024, 1, 1))],
                                "portid string, portname string, n_total bigint, capacity bigint, event_date date")
    out = strict(raw, CHOKEPOINTS, optional=CHOKEPOINTS.names).collect()[0]
    assert out["n_total"] == 5 and out["n_tanker"] is None
    big = spark.createDataFrame([("1", 2 ** 40)], "portid string, n_total bigint")
    with pytest.raises(Exception):
        strict(big, CHOKEPOINTS, optional=CHOKEPOINTS.names).collect()


def test_strict_nan_to_int_fails(spark):
    df = spark.createDataFrame([("1", float("nan"))], "portid string, n_total double")
    with pytest.raises(Exception):
        strict(df, CHOKEPOINTS, optional=CHOKEPOINTS.names).collect()


def _master(spark, pairs):
    """Master attribute rows from JSON text (values keep number vs text)."""
    df = spark.createDataFrame([(t,) for t in pairs], "j string")
    return df.select(F.from_json("j", MASTER_ATTRS).alias("a")).select("a.*")


def test_lenient_casts(spark):
    rows = ['{"portid": 1, "portname": "A", "vessel_count_total": "7"}',
            '{"portid": 2, "portname": "B", "vessel_count_total": "12.5"}',
            '{"portid": 3, "portname": "C", "vessel_count_total": 12.7}',
            '{"portid": 4, "portname": "D", "vessel_count_total": "n/a"}',
            '{"portid": 5, "portname": "E", "vessel_count_total": null}',
            '{"portid": 6, "portname": "F", "vessel_count_total": NaN, "lat": NaN, "lon": "NaN"}']
    out = {r["portid"]: r for r in lenient(_master(spark, rows), MASTER).collect()}
    assert [out[str(i)]["vessel_count_total"] for i in range(1, 7)] == [7, None, 12, None, None, None]
    assert out["6"]["lat"] is None
    assert out["6"]["lon"] != out["6"]["lon"]  # text "NaN" stays NaN


def test_lenient_null_key(spark):
    rows = ['{"portname": "A"}', '{"portid": "9", "portname": "B"}']
    m = _master(spark, rows)
    assert [r["portid"] for r in lenient(m, MASTER).collect()] == ["9"]
    assert sorted(r["portid"] for r in lenient(m, MASTER, null_key="text").collect()) == ["9", "None"]


def test_strip_all_white_space(spark):
    df = spark.createDataFrame([(" \t NAME\n\r\x0b",), (None,), ("　X Y ",)], "s string")
    assert [r[0] for r in df.select(strip_ws("s")).collect()] == ["NAME", "", "X Y"]


def test_calendar_inclusive_and_reversed(spark):
    assert calendar(spark, "2024-01-30", "2024-02-02").count() == 4
    assert calendar(spark, "2024-02-02", "2024-01-30").count() == 0
    assert month_list("2024-01-30", "2024-03-01") == [dt.date(2024, 1, 1), dt.date(2024, 2, 1),
                                                      dt.date(2024, 3, 1)]


def test_date_window_precedence():
    now = "2024-01-31"
    assert predicates.date_window(now, 5, "2024-01-01", "2024-01-02") == (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert predicates.date_window(now, 5, "2024-01-01") == (dt.date(2024, 1, 1), None)
    assert predicates.date_window(now, 0) == (dt.date(2024, 1, 31), None)
    assert predicates.date_window(now, None, None, "2024-01-02") == (dt.date(2024, 1, 1), None)
    assert predicates.date_window(now) == (dt.date(2024, 1, 1), None)
    assert predicates.default_range(now) == (dt.date(2024, 1, 22), dt.date(2024, 2, 1))


def test_ids_predicate(spark):
    df = spark.createDataFrame([("O'Brien",), ("1",), ("2",)], "portname string")
    assert predicates.ids("portname", None) is None and predicates.ids("portname", []) is None
    assert df.where(predicates.ids("portname", "O'Brien")).count() == 1
    assert df.where(predicates.ids("portname", [1, 2])).count() == 2
