import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eqlake.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="eqlake-tests")
    yield s


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="eqlake-test-")
