import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from eventlake.session import build_session
    s = build_session("local[4]", app_name="eventlake-tests", shuffle_partitions=4)
    # Tests own their scratch folder; a cluster would name spark.checkpoint.dir.
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventlake-tests-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "wh")
