import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rollbook.session import local_session

    session = local_session("8", "rollbook-tests", "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """A frame of tuples, and back."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make


def as_set(df):
    return sorted(map(tuple, df.collect()), key=str)
