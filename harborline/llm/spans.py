"""Spans of regular expressions, in code points, from SQL functions alone.

Spark extracts the matches of a pattern and splits a text at them, both from
the left and without overlap; the lengths of the parts between the matches and
of the matches themselves give each match's place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:long,end:long,value:string,part:string>"
EMPTY = f"array<{SPAN}>"


def no_spans() -> Column:
    return F.array().cast(EMPTY)


def matches(text: Column, kind: str, pattern: str, part: int = 0, when: Column | None = None) -> Column:
    """All matches, an array of ``SPAN``: ``value`` is the match and ``part``
    its group ``part``. ``when``: a cheap test that each text with a match
    passes. A null text gives an empty array."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(part))
    rows = F.arrays_zip(found.alias("value"), parts.alias("part"), F.split(text, pattern, -1).alias("gap"))
    start = lambda acc, row: acc["at"] + F.length(row["gap"])
    spans = F.aggregate(
        F.filter(rows, lambda row: row["value"].isNotNull()),
        F.struct(F.lit(0).cast("long").alias("at"), no_spans().alias("spans")),
        lambda acc, row: F.struct(
            (start(acc, row) + F.length(row["value"])).cast("long").alias("at"),
            F.concat(acc["spans"], F.array(F.struct(
                F.lit(kind).alias("kind"), start(acc, row).cast("long").alias("start"),
                (start(acc, row) + F.length(row["value"])).cast("long").alias("end"),
                row["value"].alias("value"), row["part"].alias("part"),
            ))).cast(EMPTY).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    test = text.rlike(pattern) if when is None else when & text.rlike(pattern)
    return F.when(test, spans).otherwise(no_spans())


def ordered(spans: Column, kinds: list[str], by_kind: bool) -> Column:
    """Sorted by kind as listed and then start, or by start and then kind."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, kinds)), s["kind"]).cast("long")
    keyed = F.transform(spans, lambda s: F.struct(*((rank(s).alias("a"), s["start"].alias("b")) if by_kind else (s["start"].alias("a"), rank(s).alias("b"))), s["end"].alias("end"), s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda s: s["span"])


def as_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
