import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortlens.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", shuffle_partitions=4, app_name="cohortlens-tests",
                    extra={"spark.driver.memory": "4g",
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="cl-wh-")})
    yield s


@pytest.fixture
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="cl-test-")


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
