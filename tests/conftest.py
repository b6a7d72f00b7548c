import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from haplometh.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", "4g")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows as a sorted list of tuples, nulls first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(map(tuple, picked.collect()), key=lambda r: tuple((v is not None, v) for v in r))

    return collect
