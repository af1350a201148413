import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quire.session import local_session, release_tables
    s = local_session(4, shuffle_partitions=4, app="quire-tests")
    yield s
    release_tables(s)
    s.stop()
