"""Scalar column functions (all built from pyspark.sql.functions; no UDFs)."""

from harborline.functions.casts import lenient, strict
from harborline.functions.dates import calendar, event_date, month_start
from harborline.functions.text import commit_message, strip_ws

__all__ = ["lenient", "strict", "calendar", "event_date", "month_start",
           "commit_message", "strip_ws"]
