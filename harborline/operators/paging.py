"""Paging: the service's page-stop rule, and global row numbering in pages.

Stop rule (per request, pages in offset order): a page that carries an
`error`, has no features, or is not flagged `exceededTransferLimit` is the
last one read; later pages are ignored. An error page contributes no rows.

A stored request must be whole: it starts at offset 0, each page starts where
the one before it ends, and it has a last page. A page that cannot be read
counts as an error page.

The heads of all pages (offset, number of features, flags) are written once;
first stop and first gap per request are grouped minima over them (partial
aggregation, so a request with millions of pages is reduced map-side), joined
back on the request; no window over all pages of a request is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.session import materialize


def unreadable(pages: DataFrame) -> Column:
    return F.coalesce(F.col("unreadable"), F.lit(False)) if "unreadable" in pages.columns else F.lit(False)


def n_features(pages: DataFrame) -> Column:
    """Records of a page: its head, where the page came with one (then the
    records themselves need not be read)."""
    n = F.col("n_features") if "n_features" in pages.columns else F.size("features")
    return F.greatest(F.coalesce(n, F.lit(0)), F.lit(0))


def stop_flag(pages: DataFrame) -> Column:
    return (F.col("error").isNotNull() | unreadable(pages)
            | (n_features(pages) <= 0)
            | ~F.coalesce(F.col("exceededTransferLimit"), F.lit(False)))


def request_ends(pages: DataFrame) -> DataFrame:
    """Per request: `_stop_at`, its first stop page, and `_gap_at`, the first
    page (or 0) that does not start where another one ends; null if none."""
    heads = materialize(pages.where(F.col("request").isNotNull()).select(
        "request", "offset", n_features(pages).alias("n"),
        stop_flag(pages).alias("stop")), "page-heads")
    ends = heads.where("NOT stop").select("request", (F.col("offset") + F.col("n")).alias("offset")).distinct()
    gaps = heads.where("offset <> 0").join(ends, ["request", "offset"], "left_anti") \
        .groupBy("request").agg(F.min("offset").alias("_gap"))
    stops = heads.groupBy("request").agg(F.min(F.when(F.col("stop"), F.col("offset"))).alias("_stop_at"),
                                         F.min("offset").alias("_first"))
    return stops.join(gaps, "request", "left").select(
        "request", "_stop_at", F.when(F.col("_first") != 0, 0).otherwise(F.col("_gap")).cast("bigint").alias("_gap_at"))


def apply_page_stop(pages: DataFrame, on_error: str = "fail",
                    meta: DataFrame | None = None) -> DataFrame:
    """Pages that the sequential reader would have read.

    on_error = "keep": an error page, an unreadable page or a gap ends the
    request, pages before it count;
    on_error = "fail": any of these before the request's stop fails the job,
    and so do an unreadable line of no known request and a request without a
    last page.
    meta: the same pages read with a metadata-only schema (features as empty
    structs): the stop offsets are then found without converting any
    attribute, and only the main pass parses the records.
    """
    if on_error not in ("keep", "fail"):
        raise ValueError("on_error must be 'keep' or 'fail'")
    # one row per request, written first: the planner then sees its real size
    # and broadcasts it when small (Spark's threshold is the check), so the
    # pages themselves are never shuffled for this join
    ends = materialize(request_ends(pages if meta is None else meta), "page-stops")
    bad = unreadable(pages)
    joined = pages.join(ends, "request", "left")
    gap = F.col("_gap_at").isNotNull() & (F.col("_gap_at") <= F.coalesce(F.col("_stop_at"), F.col("_gap_at")))
    read = F.col("_stop_at").isNull() | (F.col("offset") <= F.col("_stop_at"))
    at = F.concat(F.coalesce("request", F.lit("?")), F.lit("@"), F.coalesce(F.col("offset").cast("string"), F.lit("?")))
    keep = read & F.col("error").isNull() & ~bad & (~gap | (F.col("offset") < F.col("_gap_at")))
    if on_error == "fail":
        fault = (F.when(bad & (F.col("request").isNull() | read), F.concat(F.lit("unreadable page "), at))
                 .when(gap, F.concat(F.lit("missing page before "), F.col("request"), F.lit("@"), F.col("_gap_at").cast("string")))
                 .when(F.col("_stop_at").isNull(), F.concat(F.lit("no last page of "), F.col("request")))
                 .when(F.col("error").isNotNull() & read, F.concat(F.lit("service error on page "), at)))
        # one filter condition, so no part of it can be pushed below the check
        # and column pruning cannot remove it; and once more in the features,
        # as exploding them drops pages without any before that filter
        keep = F.when(fault.isNotNull(), F.raise_error(fault).cast("boolean")).otherwise(keep)
        joined = joined.withColumn("features", F.when(fault.isNotNull(), F.raise_error(fault).cast(
            pages.schema["features"].dataType)).otherwise(F.col("features")))
    return joined.where(keep).select(*[c for c in pages.columns if c != "unreadable"])


def flatten(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per feature: the page's `attributes` struct flattened."""
    return (pages.select(*keep, F.explode("features").alias("f"))
            .select(*keep, "f.attributes.*"))


def number_rows(df: DataFrame, order: list, size: int | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """Global 0-based row number in `order` (plus page number for `size`).

    Range-partition and sort, count rows per partition (one small row per
    partition), prefix-sum those counts, and add each row's position inside
    its partition -- no single-partition window over the data.
    `order` must be a total order for the numbering to be deterministic.
    """
    spark = df.sparkSession
    # as many ranges as a shuffle has partitions (an explicit count is not coalesced by AQE)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = materialize(ranged, "row-numbers")  # ids fixed once for both uses below
    counts = (ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                         F.min("_mid").alias("_first"))
              .withColumn("_base", F.coalesce(
                  F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
                      Window.unboundedPreceding, -1)), F.lit(0))))
    out = (ranged.join(counts.select("_pid", "_base", "_first"), "_pid")
           .withColumn("row_no", F.col("_base") + F.col("_mid") - F.col("_first"))
           .drop("_pid", "_mid", "_base", "_first"))
    if size:
        out = out.withColumn("page_no", F.floor(F.col("row_no") / size).cast("bigint"))
    return out


def page(df: DataFrame, order: list, offset: int, size: int) -> DataFrame:
    """One page: rows offset .. offset+size-1 of `order`, however far the
    offset (the rows before it are counted, not gathered)."""
    rows = number_rows(df, order)
    return (rows.where(F.col("row_no").between(offset, offset + size - 1))
            .orderBy("row_no").drop("row_no"))
