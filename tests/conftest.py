import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    home = tmp_path_factory.mktemp("warehouse")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("supportlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(home))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression over one row of literals."""

    def value(expression, **columns):
        from pyspark.sql import functions as F

        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()], F.lit(0).alias("_x"))
        return row.select(expression.alias("v")).first()["v"]

    return value
