"""Every registered query against its SQL on the shared tables."""

import pytest

from __spark_entry__ import entry
from catalog.oracle import ORACLE
from catalog.queries import QUERIES
from tests.check_oracle import compare, connect
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


#: Held against brute force in test_difference.py instead.
WITHOUT_SQL = {"answer_changes"}


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert compare(df, con, name) == ""
    assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_entry(spark):
    assert entry(spark).columns == ["id", "pos", "split", "written", "user"]
