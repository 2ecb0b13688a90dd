import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from eventide.session import build_session
    s = build_session("local[*]", "eventide-tests", shuffle_partitions=8,
                      conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="eventide-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_spark(tmp_path):
    return str(tmp_path)
