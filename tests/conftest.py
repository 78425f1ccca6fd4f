import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from chanlake.session import CLUSTER_CONF
    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8") \
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="chanlake-test-wh-"))
    for k, v in CLUSTER_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():      # tests only: no shared folder configured
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="chanlake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from chanlake.session import shared_path
    return shared_path(spark, "test")
