"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from conftest import SF
from tools.check import compare, connect

ALL = sorted(entry.queries())


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", ALL)
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got)
        return
    assert compare(got, con.execute(sql).df()) == ""


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
