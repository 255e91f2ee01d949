import importlib

import pytest

from suite import all_checks, all_queries
from suite.compare import compare, connect

SF = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_agrees_with_its_sql(spark, con, name):
    assert compare(spark, con, name, SF) == ""


def test_entry_points(spark):
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(all_queries()) <= set(entry.queries()) and set(all_checks()) <= set(entry.oracle_sql())
    assert entry.entry(spark).count() > 0
