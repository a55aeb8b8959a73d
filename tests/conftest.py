import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from rowsieve.session import configure, ensure_checkpoint_dir

    s = (
        SparkSession.builder.master("local[4]")
        .appName("rowsieve-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    # tests only: the session names no shared checkpoint folder, so use a fresh local one
    ensure_checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="rowsieve-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture
def tmp_out():
    return tempfile.mkdtemp(prefix="rowsieve-out-", dir="/tmp")
