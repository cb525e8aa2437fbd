import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from speechframe.session import drop_workspace, local_session

    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_workspace(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def values(df, *order):
    """Rows as plain tuples, sorted when columns are named."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
