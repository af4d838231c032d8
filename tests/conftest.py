import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cratewise.session import prepare  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("cratewise-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def as_of():
    return dt.datetime(2001, 8, 10)


@pytest.fixture
def rows(spark):
    """Make a DataFrame from rows and a schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)


@pytest.fixture
def plan_of():
    """Physical plan text of a DataFrame; the final one after it ran."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()


def as_set(df):
    return sorted(tuple(row) for row in df.collect())
