"""Pages of the statistics service, stored as JSON documents.

A stored response is one JSON object per page:
  {"features": [{"attributes": {...}}, ...], "exceededTransferLimit": bool}
or {"error": {...}}. Pages are read with an explicit schema (no inference)
either from files laid out as `<root>/request=<r>/offset=<n>/*.json` (partition
discovery yields `request` and `offset`) or from a DataFrame of response text.
A response that is no JSON (cut off, say) becomes a row with `unreadable`; it
is never taken for a page without features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.functions.dates import event_date
from harborline.operators import paging, predicates
from harborline.schemas import DATASETS, page_schema


CORRUPT = T.StructField("_corrupt_record", T.StringType())


def _marked(pages: DataFrame, *columns: str) -> DataFrame:
    """`columns` and `unreadable`, from rows read with the corrupt-record column."""
    return pages.select(*columns, F.col("_corrupt_record").isNotNull().alias("unreadable"))


def read_pages(spark: SparkSession, path: str, dataset: str, multi_line: bool = True) -> DataFrame:
    """Page files laid out as request=<r>/offset=<n>/<file> (one response per
    file; multi_line=False for one response per line)."""
    page = page_schema(DATASETS[dataset].attrs)
    schema = T.StructType(page.fields + [T.StructField("request", T.StringType()), T.StructField("offset", T.LongType()), CORRUPT])
    rows = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return _marked(rows, "request", "offset", *page.names)


def _log(spark: SparkSession, path: str, page: T.StructType) -> DataFrame:
    schema = T.StructType([T.StructField("request", T.StringType()),
                           T.StructField("offset", T.LongType()),
                           T.StructField("response", page), CORRUPT])
    return _marked(spark.read.schema(schema).json(path), "request", "offset", "response.*")


def read_page_log(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Responses stored as JSON lines with an envelope
    {"request": r, "offset": n, "response": {...}} -- few large files instead
    of one file per page, so listing stays cheap however many pages exist. A
    line that is cut off has no request any more; the gap that it leaves in its
    request is found by the stop rule."""
    return _log(spark, path, page_schema(DATASETS[dataset].attrs))


# a page with its records reduced to empty objects: enough for the stop rule
META_PAGE = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([]))),
    T.StructField("exceededTransferLimit", T.BooleanType()),
    T.StructField("error", T.StructType([T.StructField("code", T.LongType())])),
])


def read_page_log_meta(spark: SparkSession, path: str) -> DataFrame:
    """Page metadata of a page log (request, offset, record count via an
    array of empty structs, truncation flag, error): the JSON reader skips
    the records' contents instead of converting them."""
    return _log(spark, path, META_PAGE)


def page_log_lines(text: DataFrame, body: str = "body") -> DataFrame:
    """Envelope lines (for `read_page_log`) from (request, offset, body text)."""
    head = F.regexp_replace(F.to_json(F.struct("request", "offset")), r"\}$", "")
    return text.select(F.concat(head, F.lit(',"response":'), F.col(body), F.lit("}")).alias("value"))


def parse_pages(text: DataFrame, dataset: str, body: str = "body") -> DataFrame:
    """Pages from response text: columns request, offset and `body`."""
    page = page_schema(DATASETS[dataset].attrs)
    p = F.from_json(F.col(body), T.StructType(page.fields + [CORRUPT]), {"columnNameOfCorruptRecord": CORRUPT.name})
    # parsed through a one-row Generate, so filters on page fields (the stop
    # rule) stay above the parse instead of re-running from_json per term
    rows = text.select("request", F.col("offset").cast("bigint").alias("offset"),
                       F.inline(F.array(F.struct(p.alias("p")))))
    return rows.select("request", "offset", *(f"p.{c}" for c in page.names),
                       (F.col("p").isNull() | F.col("p._corrupt_record").isNotNull()).alias("unreadable"))


def stat_rows(pages: DataFrame, on_error: str = "fail", meta: DataFrame | None = None) -> DataFrame:
    """All features of the pages a sequential reader would have read, with the
    raw `date` replaced by `event_date` (epoch ms or text; 0/null -> null).
    `meta`: the pages read by `read_page_log_meta` (cheaper stop pass)."""
    rows = paging.flatten(paging.apply_page_stop(pages, on_error, meta), keep=("request", "offset"))
    return rows.withColumn("event_date", event_date("date")).drop("date")


def master_rows(pages: DataFrame, on_error: str = "keep", meta: DataFrame | None = None) -> DataFrame:
    """Master features, nameless rows dropped (values stay variants)."""
    rows = paging.flatten(paging.apply_page_stop(pages, on_error, meta))
    name = F.try_variant_get(F.col("portname"), "$", "string")
    return rows.where(name.isNotNull() & (name != ""))


def stat_scan(pages: DataFrame, dataset: str, ids=None, days: int | None = None,
              start=None, end=None, now=None, on_error: str = "fail",
              meta: DataFrame | None = None) -> DataFrame:
    """Statistics rows of a dataset under the date and id predicates."""
    ds = DATASETS[dataset]
    rows = stat_rows(pages, on_error, meta)
    return predicates.apply(rows,
                            predicates.date_range("event_date", now, days, start, end),
                            predicates.ids(ds.id_column, ids))
