import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "scripts")]

@pytest.fixture(scope="session")
def spark():
    from plan_log import log_conf
    from tarmac.session import build_session

    s = build_session("local[*]", shuffle_partitions=8, app_name="tarmac-tests", extra=log_conf())
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint folder."""
    from tarmac.session import work_path

    return work_path(spark, "test")
