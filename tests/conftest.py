import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from listloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
