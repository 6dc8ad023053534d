import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    session = (SparkSession.builder.master("local[8]").appName("viewtide-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def facts(spark):
    """Page-day facts from (day, title, views) tuples."""
    def make(*rows):
        from pyspark.sql import functions as F
        frame = spark.createDataFrame(rows, "day STRING, page_title STRING, views BIGINT")
        return frame.select(F.col("day").cast("date").alias("day"),
                            F.lit("en").alias("domain_code"), "page_title", "views")
    return make


@pytest.fixture
def set_conf(spark):
    """Sets session options for one test."""
    before = {}

    def put(name, value):
        before.setdefault(name, spark.conf.get(name))
        spark.conf.set(name, value)
    yield put
    for name, value in before.items():
        spark.conf.set(name, value)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()
