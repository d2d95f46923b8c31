import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ticklake.session import build_session, ensure_checkpoint_dir
    s = build_session("local[4]", app="ticklake-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="ticklake-test-ckpt-"))
    yield s
    s.stop()
