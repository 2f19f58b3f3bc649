import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tablefit.session import checkpoint_root, get_session

    s = get_session(app="tablefit-tests", master="local[*]", shuffle_partitions=8)
    checkpoint_root(s)  # tests run without a cluster-provided folder
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
