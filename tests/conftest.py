import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakekpi.session import build_session

    ckpt = tempfile.mkdtemp(prefix="lakekpi-test-ckpt-")
    s = build_session("local[*]", app="lakekpi-tests", shuffle_partitions=8, **{"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def sf():
    return SF
