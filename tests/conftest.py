import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from formmart.session import get_session
    s = get_session("local[4]", app="formmart-tests", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="formmart-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
