"""Every registered query next to its SQL on the smallest tables."""

import pytest
from check import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from riskframe.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, message, _ = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert ok, message
