import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from voxledger.session import build_session

    s = build_session("voxledger-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
