import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from emporium.session import get_session

    s = get_session(master="local[4]", shuffle_partitions=4, app_name="emporium-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="emporium-test-", dir="/tmp")


SF_SMALL = "/root/testdata/sf0.001"
