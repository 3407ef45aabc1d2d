"""Every query runs and equals its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) & set(entry.oracle_sql())))
def test_query(spark, connection, name):
    assert compare(spark, connection, SF, name, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    rows = {r.outcome: r.events for r in entry.entry(spark).collect()}
    assert rows["CLEAN"] > 0 and "DUPLICATE_EVENT" in rows
