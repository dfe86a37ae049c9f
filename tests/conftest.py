import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    tmp = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{tmp}/shared").config("spark.sql.warehouse.dir", f"{tmp}/warehouse").config("spark.driver.memory", "4g").getOrCreate()
    )
    yield session
    session.stop()
