import pytest

from __spark_entry__ import entry, oracle_sql, queries
from graphtide.plans.oracle import ORACLE
from graphtide.plans.queries import REGISTRY
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["_vid", "last_event", "value", "props", "seen_at"]


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_agrees_with_sql(spark, sf_dir, con, name):
    assert compare(REGISTRY[name](spark, sf_dir), con, ORACLE[name]) is None
