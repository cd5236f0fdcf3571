import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from refloom.session import ensure_checkpoint_dir, local_session

    s = local_session("*", shuffle_partitions=8, app="refloom-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
