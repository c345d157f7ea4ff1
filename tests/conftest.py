import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from godown.session import build_session
    s = build_session(master="local[4]", app="godown-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
