import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
# Python workers import the library by path
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

from pyspark.sql import SparkSession  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("corpus-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "5")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="corpus-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def docs(spark):
    """A frame of (doc_id, text) with columns that a careless operator would
    clash with."""
    def make(rows):
        frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, node string, n int, length int")
        return frame.repartition(3)
    return make
