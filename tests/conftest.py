import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from scenetrail.session import local_session, release

    session = local_session("scenetrail-tests", 8, 8)
    yield session
    release(session)
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted plain tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
