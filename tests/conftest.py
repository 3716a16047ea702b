import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cardloom.session import build_session
    session = build_session("tests", memory="6g", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TESTDATA_DIR", "/root/testdata") + "/sf0.001"
