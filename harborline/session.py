"""Session helpers: a local session for tests/bench and the shared scratch root.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it. A directory of our own is chosen only when
that setting is absent (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings for a large cluster (e.g. 1,000 executors, ~100 TB of input). They
# are what the library's plans assume; the platform sets them on the session.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    # start high and let AQE coalesce (tens of TB of shuffle / 256 MB)
    "spark.sql.shuffle.partitions": "100000",
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    # broadcast only what Spark has measured to be small (zones, months, stop offsets)
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # streaming state on disk, not in the heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("harborline")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, stream checkpoints and sinks.

    Taken from ``spark.checkpoint.dir`` (the folder the cluster names); only when
    it is unset do we pick a local one and register it, which happens in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="harborline-")  # local runs only
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder name under the scratch root (created
    by whichever Spark writer uses it first)."""
    return f"{scratch_root(spark)}/harborline/{name}-{uuid.uuid4().hex[:12]}"


class Staging:
    """Written intermediate tables of one job, removed when the job ends.

    with Staging(spark) as stage:
        rows = stage(df, "rows")
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self):
        return self

    def __call__(self, df, name: str, by: list[str] | None = None):
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        (df.write.partitionBy(*by) if by else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_):
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def spread(df):
    """Deal a frame out over the shuffle partitions before CPU-heavy per-row
    work (one file may be one row group, and so one task)."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def materialize(df, name: str = "stage", by: list[str] | None = None):
    """Write `df` as Parquet into a fresh folder under the shared scratch root
    and read it back: the lineage is cut and every later use reads the files
    (one computation; an eager RDD checkpoint would compute the plan twice
    unless cached). Survives the loss of any executor once written. `by`:
    partition columns."""
    path = scratch_path(df.sparkSession, name)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
