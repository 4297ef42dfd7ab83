"""Month-partitioned statistics tables and snapshot master tables on Parquet.

Two kinds of statistics tables: plain ones (`write_months`/`read_stats`), whose
months are replaced in place, and loaded ones (`write_load`/`read_loads`), where
each load writes the months it replaces to a folder of its own and the commit
log says which folder holds each month now.

Statistics tables carry a stored partition column `event_month` (first day
of the month of `event_date`). Readers add the month predicate matching their
date predicate, so only the touched month directories are listed and read.
The month writer replaces whole months with dynamic partition overwrite
only, which leaves untouched months in place; a static overwrite of a path
that is being read would delete the input first, so it is never used for
loads (only `create_stats(recreate=True)`, which reads nothing, empties a
table that way).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.functions.dates import month_start
from harborline.operators import commitlog, predicates

MONTH, ID = "event_month", "portid"


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, month_start("event_date"))


def create_stats(spark: SparkSession, path: str, schema: T.StructType,
                 audit_type: T.DataType = T.TimestampType(), recreate: bool = False) -> None:
    """Create an empty month-partitioned table at `path`.

    recreate=False keeps existing data; recreate=True empties the table (a
    static overwrite with no rows; nothing reads the path in that job)."""
    full = T.StructType(schema.fields + [
        T.StructField("created_at", audit_type, True),
        T.StructField("updated_at", audit_type, True),
    ])
    empty = with_month(spark.createDataFrame([], full))
    if recreate:
        (empty.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(MONTH).parquet(path))
    else:
        empty.write.mode("append").partitionBy(MONTH).parquet(path)


def stored_schema(schema: T.StructType, audit_type: T.DataType = T.TimestampType()) -> T.StructType:
    """Columns as stored: table columns, audit stamps, month partition."""
    return T.StructType(schema.fields + [
        T.StructField("created_at", audit_type, True),
        T.StructField("updated_at", audit_type, True),
        T.StructField(MONTH, T.DateType(), True),
    ])


def _reader(spark: SparkSession, schema: T.StructType | None,
            audit_type: T.DataType = T.TimestampType()):
    return spark.read if schema is None else spark.read.schema(stored_schema(schema, audit_type))


def read_stats(spark: SparkSession, path: str, start=None, end=None,
               schema: T.StructType | None = None,
               audit_type: T.DataType = T.TimestampType(), ids=None) -> DataFrame:
    """Table rows with event_date in [start, end] (either bound optional) and
    with one of `ids`, if given. With `schema` (the table schema) no inference is needed and an empty
    table reads as an empty frame."""
    df = predicates.apply(_reader(spark, schema, audit_type).parquet(path), predicates.ids(ID, ids))
    if start is None and end is None:
        return df
    cond = predicates.month_bounds(MONTH, start, end)
    if start is not None:
        cond = cond & (F.col("event_date") >= F.lit(predicates.as_date(start)))
    if end is not None:
        cond = cond & (F.col("event_date") <= F.lit(predicates.as_date(end)))
    return df.where(cond)


def write_months(df: DataFrame, path: str, layout: dict | None = None) -> None:
    """Replace exactly the months present in `df`; other months stay.
    `layout`: Parquet options of the files besides those of `_writer`."""
    if MONTH not in df.columns:
        df = with_month(df)
    _writer(df, layout).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


#: Written beside an id column whose values are too many for a dictionary.
BLOOM = {"parquet.bloom.filter.enabled": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def _writer(df: DataFrame, layout: dict | None = None):
    """Writer of rows clustered by month, then id: each file holds one range
    of ids of a month and is sorted by it, so a month gets files by its size
    (AQE joins small ranges), and a reader that asks for ids skips files, row
    groups and pages by their bounds, and row groups by dictionary or Bloom
    filter."""
    if ID not in df.columns:
        return df.hint("rebalance", F.col(MONTH)).write.options(**(layout or {}))
    clustered = df.repartitionByRange(F.col(MONTH), F.col(ID)).sortWithinPartitions(MONTH, ID)
    return clustered.write.options(**{f"{k}#{ID}": v for k, v in BLOOM.items()}, **(layout or {}))


def write_load(df: DataFrame, path: str, load: str, layout: dict | None = None) -> None:
    """The months of a load, in its own folder; nothing else is touched."""
    _writer(df, layout).mode("errorifexists").partitionBy(MONTH).parquet(f"{path}/load={load}")


def read_loads(spark: SparkSession, path: str, months: dict, schema: T.StructType,
               audit_type: T.DataType = T.TimestampType()) -> DataFrame:
    """Rows of {month: load} as the commit log lists them; only those folders
    are listed and read. No months: an empty frame."""
    stored = stored_schema(schema, audit_type)
    if not months:
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).option("basePath", path).parquet(*load_folders(path, months)).select(*stored.names)


def date_bounds(spark: SparkSession, folders: list[str], base: str, date_col: str = "event_date") -> DataFrame:
    """`row_count, min_date, max_date` of stored folders, one row, from file
    footers: the DataSource V2 Parquet reader takes count, min and max of a
    date without reading rows. The reader is chosen by session settings, so
    this frame belongs to a session of its own; collect it."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    rows = own.read.option("basePath", base).parquet(*folders)
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))


def load_folders(path: str, months: dict) -> list[str]:
    """The folders of {month: load} as the commit log lists them."""
    return [f"{path}/load={load}/{MONTH}={month}" for month, load in sorted(months.items())]


def write_snapshot(df: DataFrame, root: str, snapshot: str) -> str:
    """Write an unpartitioned table as a new snapshot directory; returns it."""
    path = f"{root}/snapshot={snapshot}"
    df.write.mode("errorifexists").parquet(path)
    return path


def register_views(spark: SparkSession, root: str, names: dict) -> list[str]:
    """Expose tables under `root` as temporary views for SQL, e.g.
    `SELECT * FROM ports ORDER BY updated_at DESC LIMIT 5`.

    names: view name -> (folder under root, table schema for statistics tables
    [, type of the stored audit stamps]; or None for a snapshot folder, whose
    newest committed snapshot is used[, table name in the commit log])."""
    done = []
    for view, spec in names.items():
        folder, schema = spec[0], spec[1]
        audit_type = spec[2] if schema is not None and len(spec) > 2 else T.TimestampType()
        path = f"{root}/{folder}"
        if schema is not None:
            # event_month stays visible so that SQL can prune months with it
            df = read_stats(spark, path, schema=schema, audit_type=audit_type)
        else:
            # the snapshot that the commit log names, as every reader takes it
            table = spec[2] if len(spec) > 2 else folder
            df = spark.read.parquet(f"{path}/snapshot={commitlog.latest_snapshot(spark, f'{root}/_commits', table)}")
        df.createOrReplaceTempView(view)
        done.append(view)
    return done
