"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as e
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(e._log_queries()) == set(e._log_sql())


@pytest.mark.parametrize("name", list(e._log_queries()))
def test_query(spark, con, name):
    assert compare(e._log_queries()[name](spark, SF), con, e._log_sql()[name]) is None


def test_entry(spark):
    rows = e.entry(spark).collect()
    assert rows[0].bot_name == "GPTBot" and len(rows) == 6
