import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 4, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """make("a int, b string", (1, "x"), ...) -> DataFrame"""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


def rows_of(df, *columns):
    """Sorted tuples of the given columns."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
