import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from larder.session import build_session
    ckpt = tempfile.mkdtemp(prefix="larder-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="larder-test-wh-")
    s = build_session("local[4]", shuffle_partitions=4, app_name="larder-tests",
                      extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
