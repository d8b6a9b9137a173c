from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tillroll-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tillroll.session import prepare

    return prepare(spark)


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture(scope="session")
def train(spark):
    from fixture import SCHEMA, TRAIN

    return spark.createDataFrame(TRAIN, SCHEMA)


@pytest.fixture(scope="session")
def test_log(spark):
    from fixture import SCHEMA, TEST

    return spark.createDataFrame(TEST, SCHEMA).drop("trip_type")


@pytest.fixture(scope="session")
def both(train, test_log):
    from tillroll.sources.scanlog import union_inputs

    return union_inputs(train, test_log)


@pytest.fixture(scope="session")
def categories(spark):
    from fixture import CATEGORIES

    return spark.createDataFrame(CATEGORIES, "department string, category string")
