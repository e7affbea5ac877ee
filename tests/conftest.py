import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from harvestline.session import build_session
    scratch = tempfile.mkdtemp(prefix="harvestline-tests-")
    s = build_session("local[4]", app="harvestline-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="harvestline-t-")
