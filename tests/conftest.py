import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = (SparkSession.builder.master("local[4]")
               .appName("harborline-tests")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests only: pick a checkpoint folder when the session names none
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hl-ckpt-"))
    yield s


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="hl-test-")
