import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from titleflow.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="titleflow-tests")
    yield s


@pytest.fixture
def scratch():
    """A fresh scratch folder per test (never reused)."""
    return tempfile.mkdtemp(prefix="titleflow-test-")


SF = "/root/testdata/sf0.001"
