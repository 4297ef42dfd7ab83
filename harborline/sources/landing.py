"""Loading only what is new: a landing of responses, and pages parsed once.

A downloader appends page logs (`pages.page_log_lines`) to a landing laid out
by dataset and day of fetching, `<landing>/<dataset>/fetch_day=<d>/<file>`. A
file holds whole requests and does not change once it is there.

`ingest` is a Structured Streaming run over the landing (`availableNow`): the
checkpoint of its file source remembers which files have been read, so a run
lists the landing and reads the unseen files only. Their text is parsed once,
into Parquet pages: heads (offset, number of features, flags) in columns of
their own, which the page-stop rule reads without the features. The sink's log
makes each file's pages appear once, whatever stops the run. Pages carry
`ingest`, the trigger time of their micro-batch in microseconds: it is kept in
the checkpoint, so a batch that is done again has the same one.

`read_stage` takes the pages ingested after a cursor. The sink is partitioned
by `ingest` and fetch day, so both are partition predicates and older folders
are not listed into the scan. The loads (`jobs.load_new_*`) keep the cursor in
their commit-log row: a load that fails before its commit leaves the cursor,
and the next one takes those pages as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.functions.dates import as_date
from harborline.schemas import DATASETS, page_schema
from harborline.session import materialize
from harborline.sources.pages import CORRUPT

INGEST, FETCH_DAY = "ingest", "fetch_day"


def stage_schema(dataset: str) -> T.StructType:
    page = page_schema(DATASETS[dataset].attrs)
    return T.StructType([T.StructField("request", T.StringType()), T.StructField("offset", T.LongType()),
                         T.StructField("n_features", T.IntegerType()), *page.fields, T.StructField("unreadable", T.BooleanType()),
                         T.StructField(INGEST, T.LongType()), T.StructField(FETCH_DAY, T.DateType())])


def parse_log_lines(lines: DataFrame, dataset: str) -> DataFrame:
    """Pages with heads from envelope lines (`value`), each parsed once."""
    page = page_schema(DATASETS[dataset].attrs)
    envelope = T.StructType([T.StructField("request", T.StringType()), T.StructField("offset", T.LongType()),
                             T.StructField("response", page), CORRUPT])
    parsed = F.from_json("value", envelope, {"columnNameOfCorruptRecord": CORRUPT.name})
    # through a one-row Generate, so that no later expression parses again
    rows = lines.select(F.inline(F.array(F.struct(parsed.alias("p")))), *(c for c in lines.columns if c != "value"))
    return rows.select(
        "p.request", "p.offset", F.greatest(F.coalesce(F.size("p.response.features"), F.lit(0)), F.lit(0)).alias("n_features"), "p.response.*",
        (F.col("p").isNull() | F.col(f"p.{CORRUPT.name}").isNotNull()).alias("unreadable"), *(c for c in lines.columns if c != "value"))


def read_log_once(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """A page log (JSON lines with an envelope, `pages.read_page_log`) parsed
    once into staged Parquet pages, for a load that takes the whole log."""
    pages = parse_log_lines(spark.read.text(path), dataset)
    return materialize(pages, "parsed-pages")


def ingest(spark: SparkSession, landing: str, stage: str, dataset: str, max_files_per_trigger: int | None = None) -> int:
    """Read the files that the landing has and no earlier call has read;
    returns the number of their lines."""
    r = spark.readStream.format("text").schema(f"value string, {FETCH_DAY} date")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = parse_log_lines(r.load(f"{landing}/{dataset}"), dataset)
    pages = pages.withColumn(INGEST, F.unix_micros(F.current_timestamp()))  # that of the micro-batch
    query = (pages.select(*stage_schema(dataset).names).writeStream.format("parquet").outputMode("append").partitionBy(INGEST, FETCH_DAY)
             .option("path", f"{stage}/{dataset}").option("checkpointLocation", f"{stage}/_cursor/{dataset}").trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def read_stage(spark: SparkSession, stage: str, dataset: str, after: int | None = None, fetched=None) -> DataFrame:
    """Pages ingested after the cursor `after`, of the fetch days `fetched`
    (first, last; either may be None)."""
    pages = spark.read.schema(stage_schema(dataset)).parquet(f"{stage}/{dataset}")
    if after is not None:
        pages = pages.where(F.col(INGEST) > F.lit(after))
    lo, hi = fetched or (None, None)
    if lo is not None:
        pages = pages.where(F.col(FETCH_DAY) >= F.lit(as_date(lo)))
    if hi is not None:
        pages = pages.where(F.col(FETCH_DAY) <= F.lit(as_date(hi)))
    return pages


def cursor(pages: DataFrame) -> int | None:
    """The latest ingest of `pages`; None if there are none. From partition
    values: no file is read."""
    return pages.agg(F.max(INGEST).alias("c")).first()["c"]
