import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tenderfold.session import build_session
    shared = tmp_path_factory.mktemp("shared")
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="tenderfold-tests",
                      extra={"spark.checkpoint.dir": f"file://{shared}"})
    yield s
    s.stop()


@pytest.fixture
def tmpdir_fresh(tmp_path):
    return str(tmp_path)
