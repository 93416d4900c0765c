import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from airshed.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="airshed-tests")
    if not s.sparkContext.getCheckpointDir():
        d = tempfile.mkdtemp(prefix="airshed-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
