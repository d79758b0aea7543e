import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from labelkiln.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, app_name="labelkiln-tests",
                      extra={"spark.default.parallelism": "4"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="labelkiln-test-ckpt-"))
    yield s
    s.stop()
