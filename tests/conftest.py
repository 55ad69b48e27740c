import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="candlewick-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("candlewick-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.maxMetadataStringLength", "1000")  # plans show whole paths, wherever the temp folder is
         .config("spark.checkpoint.dir", ckpt)
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="candlewick-test-wh-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from candlewick.session import scratch_path
    return scratch_path(spark, "test")


SF_SMALL = "/root/testdata/sf0.001"
