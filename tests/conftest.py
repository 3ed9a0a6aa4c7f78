import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from deckspark.session import DEFAULT_CONF

    b = SparkSession.builder.master("local[4]").appName("deckspark-tests")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "8g")
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="deckspark-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
