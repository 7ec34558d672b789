import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from lodestar.session import build_session

    scratch = tempfile.mkdtemp(prefix="lodestar-test-")
    s = build_session(
        master="local[*]",
        app_name="lodestar-tests",
        shuffle_partitions=8,
        extra_conf={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"), "spark.sql.warehouse.dir": os.path.join(scratch, "wh")},
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def scratch_dir():
    return tempfile.mkdtemp(prefix="lodestar-test-files-")
