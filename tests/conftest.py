import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("kiln-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder; a cluster names a shared one.
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kiln-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="kiln-test-")
