import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cadence.session import get_session

    s = get_session(master="local[*]", shuffle_partitions=8, app="cadence-tests")
    yield s
    s.stop()
