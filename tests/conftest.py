import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerspark.session import build_session
    ckpt = str(tmp_path_factory.mktemp("checkpoints"))
    s = build_session("local[4]", app="ledgerspark-tests", shuffle_partitions=4, checkpoint_dir=ckpt)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
