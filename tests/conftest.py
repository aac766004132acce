import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trafficlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        int(os.environ.get("TEST_CPUS", "8")), "trafficlake-tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
