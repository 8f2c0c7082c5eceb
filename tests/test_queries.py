import os

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from sievemark.catalog.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) > 5
    assert entry(spark).columns == ["dq_rule_id", "issue_count"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    assert differences(spark, queries()[name], oracle_sql()[name], SF_DIR, duck) == []
