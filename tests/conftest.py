import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("lakemart-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "America/Sao_Paulo")  # results must not depend on it
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, str(value))

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def tables(spark):
    """A lake whose source tables are given as {table: (ddl, rows)}."""
    from lakemart import Lake

    def build(gold=None, **frames):
        made = {name: spark.createDataFrame(rows, ddl) for name, (ddl, rows) in frames.items()}
        return Lake(spark, made.__getitem__, gold)

    return build


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
