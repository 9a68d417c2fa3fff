"""Every registered query on the smallest tables, against its SQL where it has one."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SLOW = ("m01_", "m03_", "m04_", "m05", "m06", "m08", "m09", "m1", "k09", "p11b")  # fitting is covered by test_learning on fixtures


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, data, con, name):
    sql = entry.oracle_sql().get(name)
    if name.startswith(SLOW):
        pytest.skip("fitting is tested on fixtures")
    df = entry.queries()[name](spark, data)
    if sql is None:
        assert len(df.columns) > 0 and df.count() >= 0
    else:
        assert compare(df, con, sql) == ""


def test_entry_point(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
