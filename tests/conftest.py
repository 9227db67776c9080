import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tracelake.session import SHARED_DIR_CONF, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(8, "tracelake-tests")
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get(SHARED_DIR_CONF, None):
        s.conf.set(SHARED_DIR_CONF, str(tmp_path_factory.mktemp("shared")))
    yield s
    s.stop()
