import os
import sys
import tempfile
import time

# Test rows are built from Python datetimes, which PySpark reads in the
# process's local zone; pin it to the session zone.
os.environ["TZ"] = "UTC"
time.tzset()

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationlake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="stationlake-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="stationlake-tests",
        shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": ckpt, "spark.sql.adaptive.enabled": "true"},
    )
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="stationlake-test-")
