import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("SHELFCAST_DRIVER_MEMORY", "4g")
    from shelfcast.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.exists(SF_SMALL):
        pytest.skip("driver test data not present")
    return SF_SMALL
