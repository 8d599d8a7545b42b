import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app_name="tierlake-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp_root():
    """A fresh scratch folder per test (never cleared, never reused)."""
    return tempfile.mkdtemp(prefix="tierlake-test-")
