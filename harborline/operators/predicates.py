"""Row predicates of the statistics loads (dates, ids, names).

All predicates compare a column with driver-side literals, so Catalyst pushes
them into the Parquet scan, and `month_bounds` adds the matching predicate on
the month partition column so whole months are pruned.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.dates import as_date, days_back

DEFAULT_DAYS = 30


def date_window(now=None, days: int | None = None, start=None, end=None):
    """(low, high) inclusive bounds, high None = open.

    Precedence: start and end -> [start, end]; start only -> [start, ...);
    days given (0 counts) -> [now - days, ...); nothing -> last 30 days.
    An end without a start is ignored.
    """
    now = as_date(now) if now is not None else _dt.datetime.now(_dt.timezone.utc).date()
    if start and end:
        return as_date(start), as_date(end)
    if start:
        return as_date(start), None
    if days is not None:
        return days_back(now, days), None
    return days_back(now, DEFAULT_DAYS), None


def date_range(col: str | Column = "event_date", now=None, days: int | None = None,
               start=None, end=None) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    lo, hi = date_window(now, days, start, end)
    cond = col >= F.lit(lo)
    if hi is not None:
        cond = cond & (col <= F.lit(hi))
    return cond


def between_days(col: str | Column, start, end) -> Column:
    """Inclusive [start, end]; a null date never passes."""
    col = F.col(col) if isinstance(col, str) else col
    return col.between(F.lit(as_date(start)), F.lit(as_date(end)))


def on_day(col: str | Column, day) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col == F.lit(as_date(day))


def ids(col: str | Column, values) -> Column | None:
    """Scalar or collection of ids, compared as text; None or an empty text or
    collection of any kind = no predicate."""
    if values is None or values == "":
        return None
    values = [values] if isinstance(values, (str, int)) else list(values)
    if not values:
        return None
    col = F.col(col) if isinstance(col, str) else col
    return col.cast("string").isin([str(v) for v in values])


def apply(df: DataFrame, *conds: Column | None) -> DataFrame:
    for c in conds:
        if c is not None:
            df = df.where(c)
    return df


def named(df: DataFrame, col: str = "portname") -> DataFrame:
    """Drop rows whose name is null or empty."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))


def default_range(now=None):
    """Default load window: UTC today-9 .. today+1, 11 inclusive days."""
    now = as_date(now) if now is not None else _dt.datetime.now(_dt.timezone.utc).date()
    return now - _dt.timedelta(days=9), now + _dt.timedelta(days=1)


def month_bounds(month_col: str, start, end) -> Column:
    """Predicate on the month partition column matching [start, end]."""
    lo = as_date(start).replace(day=1) if start else None
    hi = as_date(end).replace(day=1) if end else None
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(month_col) >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(month_col) <= F.lit(hi))
    return cond
