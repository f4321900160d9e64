import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from chunkgate.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # The folder is this machine's: a local session is the whole cluster.
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("*", 4, "6g", **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
