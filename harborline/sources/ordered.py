"""A table stored in an order, and its pages by offset without reading the rest.

`write_ordered` range-partitions the rows in the order, a folder for each
range, and stores each row's place in its range beside it, sorted. The index is
a small table of its own: a row for each range, with its first and last row's
order columns, its number of rows and of rows before it (`start`).

`read_page` takes from the index the ranges that a page lies in, one or two
where a range holds more rows than a page, and reads only their folders; the
place is a predicate on a sorted column, so Parquet skips row groups and pages
of them as well. What a page costs does not depend on how far its offset is.

The order must be total for pages to be the same each time the table is
written; rows that are equal in it stand in any order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE, PLACE = "_range", "_place"


def write_ordered(df: DataFrame, path: str, order: list[tuple[str, bool]], ranges: int | None = None) -> None:
    """Store `df` under `path` in `order`: (column, ascending) pairs.
    `ranges`: into how many ranges (the shuffle partitions by default)."""
    for c in (RANGE, PLACE):
        if c in df.columns:
            raise ValueError(f"rows have a column {c}")
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.asc(c) if up else F.desc(c) for c, up in order]
    rows = df.repartitionByRange(n, *by).sortWithinPartitions(*by)
    # an explicit count of ranges is not coalesced, so a task is a range
    rows = rows.withColumn(RANGE, F.spark_partition_id()).withColumn(PLACE, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    # the places are in order already: the sort that the writer asks for
    # (by folder) must not mix them
    rows.sortWithinPartitions(RANGE, PLACE).write.partitionBy(RANGE).parquet(f"{path}/rows")
    # a file without rows, so that an empty table has its columns
    spark.createDataFrame([], rows.schema).coalesce(1).write.parquet(f"{path}/schema")

    key = F.struct(*(c for c, _ in order))
    stored = _rows(spark, path)
    bounds = stored.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"), F.min_by(key, PLACE).alias("first"), F.max_by(key, PLACE).alias("last"))
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    bounds.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}/index")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")


def read_page(spark: SparkSession, path: str, offset: int, size: int) -> DataFrame:
    """Rows offset .. offset + size - 1, in order (fewer at the end, none
    after it)."""
    if offset < 0 or size < 1:
        raise ValueError("offset must not be negative and size must be positive")
    index = spark.read.parquet(f"{path}/index").where((F.col("start") < offset + size) & (F.col("start") + F.col("n") > offset))
    hits = index.select(RANGE, "start").orderBy("start").collect()  # the ranges of one page
    rows = _rows(spark, path)
    out = [c for c in rows.columns if c not in (RANGE, PLACE)]
    if not hits:
        return rows.where(F.lit(False)).select(*out)
    parts = [rows.where((F.col(RANGE) == h[RANGE]) & F.col(PLACE).between(offset - h["start"], offset + size - 1 - h["start"])) for h in hits]
    return reduce(DataFrame.unionByName, parts).orderBy(RANGE, PLACE).select(*out)


def n_rows(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(f"{path}/index").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
