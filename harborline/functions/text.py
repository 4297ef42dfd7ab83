"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes by default
# (str.isspace), which the vessel-name cleanup must match.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: message format of a table load.
COMMIT_FORMAT = "Upsert %d rows into %s (Range: %s to %s)"


def strip_ws(col: Column | str, default: str = "") -> Column:
    """Remove leading/trailing white space of every kind; null -> default."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.btrim(col, F.lit(PY_WHITESPACE)), F.lit(default))


def commit_message(table: str, rows: Column, min_date: Column, max_date: Column) -> Column:
    return F.format_string(COMMIT_FORMAT, rows, F.lit(table),
                           min_date.cast("string"), max_date.cast("string"))
