import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakemart.session import build_session
    s = build_session("local", master="local[*]", spark__sql__shuffle__partitions="8")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL
