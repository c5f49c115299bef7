import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import ensure_checkpoint_dir, get_spark
    s = get_spark("local[4]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="ll-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ll-test-")
