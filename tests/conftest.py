import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tripflow.session import build_session, checkpoint_dir

    warehouse = tempfile.mkdtemp(prefix="tripflow-warehouse-", dir="/tmp")
    s = build_session(
        master="local[4]", app="tripflow-tests", shuffle_partitions=8, extra={"spark.sql.warehouse.dir": warehouse}
    )
    # tests only: the session has no shared folder configured unless the environment gives one
    checkpoint_dir(s, default=tempfile.mkdtemp(prefix="tripflow-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tripflow-test-", dir="/tmp")
