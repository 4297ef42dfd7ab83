"""Helpers shared by the corpus operators: table access, staged tables, words."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.session import scratch_path

#: White space of the text contracts: blank and \x09-\x0D, which is what
#: ``bytes.split()`` splits on in Python.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACES = "[\\x20\\x09-\\x0D]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id`` and whole ``text`` (null: empty) of every document."""
    return id_text(table(spark, sf_dir, "documents"))


def id_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs["text"]).alias("text"))


def text_of(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


@contextmanager
def shuffle_files_dropped(spark: SparkSession):
    """Within it, a query's shuffle files go when the query has ended; what
    the next stage needs is in a written table."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Stages:
    """Written tables of one run, under the folder that all executors share.

    A stage cuts the lineage: it survives the loss of any executor and is
    computed once. ``drop`` removes stages that nothing reads any more; the
    ones that the returned frame reads must stay until it has been used.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_path(spark, name)}-{uuid.uuid4().hex[:8]}"

    def write(self, df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
        writer = df.write.option("compression", "zstd")
        with shuffle_files_dropped(self.spark):
            (writer.partitionBy(*by) if by else writer).parquet(self.path(label))
        return self.spark.read.schema(df.schema).parquet(self.path(label))

    def path(self, label: str) -> str:
        return f"{self.root}/{label}"

    def drop(self, *labels: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for label in labels:
            path = jvm.org.apache.hadoop.fs.Path(self.path(label))
            path.getFileSystem(conf).delete(path, True)


