import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", "/tmp/lanewright-warehouse").getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    return s


@pytest.fixture
def rows(spark):
    """Make a frame from a DDL and tuples."""

    def make(ddl, *tuples):
        return spark.createDataFrame(list(tuples), ddl)

    return make
