import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidemark.session import BASE_CONF

    ckpt = tempfile.mkdtemp(prefix="tidemark-test-ckpt-")
    b = (
        SparkSession.builder.master("local[*]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", ckpt)
        .config("spark.driver.memory", "8g")
    )
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="tidemark-test-")
