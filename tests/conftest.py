import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from scrimtally.session import local_session, tune

    session = local_session("4", 4)
    session.sparkContext.setLogLevel("ERROR")
    tune(session)
    yield session
    session.stop()


def values(df, *columns):
    """Rows as plain tuples, in a stable order."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(str(x) for x in t))


@pytest.fixture(scope="session")
def rows():
    return values
