"""Date helpers: raw service dates, months, calendars, relative windows."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_NUMERIC = r"^\s*-?[0-9]+(\.[0-9]*)?([eE][-+]?[0-9]+)?\s*$"


def event_date(raw: Column | str) -> Column:
    """Raw `date` attribute (text) -> DATE.

    A number is epoch milliseconds, taken as a UTC day whatever the session
    time zone;
    text is taken as a date literal (a bad literal fails the job under ANSI);
    null, empty text and 0 are "no date" and give null.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    num = raw.try_cast("double")
    return (
        F.when(raw.isNull() | (F.trim(raw) == ""), F.lit(None).cast("date"))
        .when(raw.rlike(_NUMERIC),
              F.when(num == 0, F.lit(None).cast("date"))
              .otherwise(F.date_from_unix_date(F.floor(num / 86400000).cast("int"))))
        .otherwise(F.trim(raw).cast("date"))
    )


def month_start(col: Column | str) -> Column:
    """First day of the month: the partition value of the statistics tables."""
    col = F.col(col) if isinstance(col, str) else col
    return F.trunc(col, "month")


def as_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.datetime.strptime(str(value), "%Y-%m-%d").date()


def days_back(now, days: int) -> _dt.date:
    """Calendar date `days` before `now` (both taken in UTC)."""
    return as_date(now) - _dt.timedelta(days=int(days))


def calendar(spark: SparkSession, start, end, name: str = "event_date") -> DataFrame:
    """Inclusive list of days from start to end; empty when start > end.

    Built with spark.range, so a long range is generated in parallel, and a
    reversed range yields no rows instead of the error `sequence` raises.
    """
    start, end = as_date(start), as_date(end)
    n = max((end - start).days + 1, 0)
    return spark.range(n).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def month_list(start, end) -> list[_dt.date]:
    """First days of all months touched by [start, end] (driver-side constants)."""
    start, end = as_date(start), as_date(end)
    out, cur = [], start.replace(day=1)
    while cur <= end:
        out.append(cur)
        cur = (cur.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    return out
