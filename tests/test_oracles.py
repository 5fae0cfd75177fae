"""Every registered query on the smallest fixture; where there is a SQL twin, results must be equal."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
# Seconds each and covered by tests of their own.
SLOW = {"g8_greedy_communities", "g10_community_crosstab", "m14_parameter_sweep", "flow_fit_topics"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_twins_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(set(queries()) - SLOW))
def test_query(spark, con, key):
    sql = oracle_sql().get(key)
    if sql is None:
        assert queries()[key](spark, SF_DIR).count() > 0
    else:
        # A filter can rightly leave nothing on 200 documents.
        assert differences(spark, con, queries()[key], sql, SF_DIR) in ("", "both empty")
