import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terrahaz.session import local_session, shared_folder  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4)
    shared_folder(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *order):
    """Collected rows as sorted tuples."""
    columns = order or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
