import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stellate.session import build_session  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="stellate-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stellate-test-ckpt-"))
    s.conf.set("stellate.lake.root", tempfile.mkdtemp(prefix="stellate-test-lake-"))
    yield s
    s.stop()
