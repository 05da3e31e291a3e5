import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from vericorpus.session import build_session

    session = build_session("local[4]", 4, spark__driver__memory="3g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    """The smallest driver tables, where they exist."""
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no driver tables here")
    return path
