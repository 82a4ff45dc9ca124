import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark import SparkConf
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[4]").appName("cartograph-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true"))
    # tests set their own shared folder only where the session has none
    if not SparkConf().contains("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cartograph-ckpt-"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def tmp_out():
    return tempfile.mkdtemp(prefix="cartograph-test-")


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def log_df(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item_id long, category_id int, behavior_type string, ts long")
