import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from rill.session import build_session

    s = build_session(
        "local[4]",
        app_name="rill-tests",
        shuffle_partitions=4,
        conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="rill-wh-")},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rill-test-")
