import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from webcorpus.session import build_session

    s = build_session("local[*]", app="webcorpus-tests", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="webcorpus-test-warehouse-")})
    # tests may set their own checkpoint folder, only where none is configured
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="webcorpus-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tmp_root():
    return tempfile.mkdtemp(prefix="webcorpus-tests-")
