import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from eavesgrid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="eavesgrid-warehouse-")
    session = local_session(8, 4, spark__sql__warehouse__dir=warehouse)
    yield session
    session.stop()
