import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from verisift.session import local_session

    s = local_session(cores=8, shuffle_partitions=8, app="verisift-tests")
    yield s
    s.stop()
