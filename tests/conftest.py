import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from rankflow.session import drop_written, local_session
    folder = tmp_path_factory.mktemp("shared")
    session = local_session("8", 8, **{"spark.checkpoint.dir": f"file://{folder}"})
    yield session
    drop_written(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
