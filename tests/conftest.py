import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from flowtriage.runtime import local_session, release

    s = local_session(cores=8, shuffle_partitions=8, app="flowtriage-tests", shared=f"file://{tmp_path_factory.mktemp('shared')}")
    yield s
    release(s)
    s.stop()
