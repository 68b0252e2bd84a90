import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quadrille.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "quadrille-tests")


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def of(df):
        found = [tuple(r) for r in df.collect()]
        return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))

    return of
