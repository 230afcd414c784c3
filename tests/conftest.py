import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    # Builder settings apply to the first session only, so they come before local_session.
    warehouse = tmp_path_factory.mktemp("warehouse")
    builder = SparkSession.builder.config("spark.sql.warehouse.dir", str(warehouse))
    builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    from graphtide.session import local_session

    session = local_session(4, "4g", "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def rows(spark):
    """Collect a DataFrame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def plan(spark):
    """Physical plan of a DataFrame as text, before any run-time change."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
