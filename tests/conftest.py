import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("MEEPLE_TEST_SF", SF_SMALL)


@pytest.fixture(scope="session")
def spark():
    from meeple.session import local_session

    session = local_session(cpus="*", shuffle_partitions=8, app="meeple-tests")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="meeple-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="meeple-test-")
