import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eddy.session import build_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8, app_name="eddy-tests")
    yield s
    s.stop()


@pytest.fixture
def scratch():
    """A fresh folder per test; never reused."""
    return tempfile.mkdtemp(prefix="eddy-test-", dir="/tmp")
