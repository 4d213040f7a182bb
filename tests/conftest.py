import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from loadpanel.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=os.environ.get("TEST_CPUS", "8"), app="loadpanel-tests")


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
