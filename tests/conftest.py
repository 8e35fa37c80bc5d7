import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from paperflow.session import checkpoint_root, local_session
    s = local_session("*", shuffle_partitions=8, app="paperflow-tests")
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
