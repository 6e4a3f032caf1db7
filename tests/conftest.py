import os
import sys
import tempfile

import pytest

_REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_TESTS = os.path.join(_REPO, "tests")
sys.path.insert(0, _REPO)
# Python workers import the package and test-defined scorers from here.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [_REPO, _TESTS] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])

SF_SMALL = "/root/testdata/sf0.001"
SF_PARITY = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from chanlytics.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="chanlytics-test-")
