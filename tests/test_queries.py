"""Every query beside its SQL over the smallest tables."""

import os

import pytest
from compare import connect, differences, duck_side, spark_side

import __spark_entry__ as entry_module
from checks import CHECKS

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {k: v for k, v in entry_module.queries().items() if k in CHECKS}
ORACLES = {k: v for k, v in entry_module.oracle_sql().items() if k in CHECKS}


@pytest.fixture(scope="session")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    left = spark_side(QUERIES[name](spark, SF_DIR))
    if name not in ORACLES:
        assert sum(left[2].values()) > 0
        return
    assert not differences(left, duck_side(con, ORACLES[name]))


def test_every_query_but_the_forest_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"predictions"}


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
