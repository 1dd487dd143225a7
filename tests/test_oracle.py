"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, entry.queries()[name], SQL[name], SF) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF).limit(1).collect()


def test_entry(spark):
    assert entry.entry(spark).columns == ["user_id", "session_no", "start", "end", "clicks", "sum_k"]
