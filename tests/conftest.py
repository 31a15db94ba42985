import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from loamframe import configure

    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="spark-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture(scope="session")
def duck():
    from compare import SF, connect

    return connect(SF)
