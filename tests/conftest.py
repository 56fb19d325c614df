import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from dwspark.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    # tests only: a checkpoint folder of our own when the session has none
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dwspark-test-"))
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
