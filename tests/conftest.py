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
    ckpt = tempfile.mkdtemp(prefix="loyalspark-test-ckpt-")
    s = (SparkSession.builder.master("local[*]")
         .appName("loyalspark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
         .getOrCreate())
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", ckpt)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="loyalspark-test-")


def tx_frame(spark, rows):
    """rows: (tx_id, user_id, 'YYYY-MM-DD HH:MM:SS', points)"""
    import datetime as dt
    data = [(int(t), int(u), dt.datetime.fromisoformat(ts), int(p), "k") for t, u, ts, p in rows]
    return spark.createDataFrame(data, "tx_id long, user_id long, ts timestamp_ntz, points long, kind string")
