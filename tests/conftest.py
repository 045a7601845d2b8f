import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidegraph.session import local_session

    s = local_session(4, 4)
    s.sparkContext.setLogLevel("OFF")
    return s


@pytest.fixture(scope="session")
def small():
    return os.environ.get("TIDEGRAPH_TEST_DATA", "/root/testdata/sf0.001")
