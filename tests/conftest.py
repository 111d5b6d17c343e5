import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session

    s = build_session("local[*]", shuffle_partitions=8)
    # Tests own their work folder when the session does not name one.
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-tests-"))
    yield s


SF = "/root/testdata/sf0.001"
