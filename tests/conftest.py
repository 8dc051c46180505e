import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fraudlake.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4)
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="fraudlake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="fraudlake-test-")
