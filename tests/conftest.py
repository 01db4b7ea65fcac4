import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quayside.session import local_session

    warehouse = tempfile.mkdtemp(prefix="qs-warehouse-")
    s = local_session(4, app="quayside-tests", **{"spark.sql.shuffle.partitions": "4",
                                                  "spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never cleared: a new one each time)."""
    return tempfile.mkdtemp(prefix="qs-test-")
