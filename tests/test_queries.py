"""Every query against its SQL, on whole tables."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from facetmill.plans.oracles import ORACLE_SQL
from facetmill.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    own = {name for name in queries() if name in QUERIES}
    assert own == set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    only_spark, only_sql, count = difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name])
    assert not only_spark and not only_sql
    assert count > 0


def test_entry_runs(spark):
    assert entry(spark).count() > 0


def test_encoded_training_reads_its_rows_once(spark):
    """F8: vocabulary and encoding both read the written training set."""
    df = QUERIES["encoded_training"](spark, SF_DIR)
    assert "lineitem" not in df._jdf.queryExecution().executedPlan().toString()
