import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stratamart.session import build

    session = build("tests", "local[4]", 2)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
