import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from colsight.session import local_session

    session = local_session(4, shuffle_partitions=4, app="colsight-tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def run(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return run


@pytest.fixture(scope="session")
def column(spark):
    """Value counts of one column from {value: count}."""

    def make(name, values):
        return spark.createDataFrame([(name, v, c) for v, c in values.items()], "column_id string, val string, count bigint")

    return make
