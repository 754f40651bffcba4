import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from revlens.session import get_session
    ck = tempfile.mkdtemp(prefix="revlens-test-")
    s = get_session("local[*]", app="revlens-tests", shuffle_partitions=8, checkpoint_dir=ck)
    yield s
    s.stop()
