import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardlake.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, 8)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame(rows, schema)`` as a DataFrame of several partitions."""
    def make(rows, schema, partitions=3):
        return spark.createDataFrame(rows, schema).repartition(partitions)
    return make


def rows(df, *by):
    """Rows as tuples in a stable order."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))
