import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rowforge.session import build_session
    s = build_session("local[4]", app="rowforge-tests", shuffle_partitions=8)
    yield s
    from rowforge.plans.queries import remove_intermediates
    remove_intermediates(s)
    s.stop()


@pytest.fixture
def scratch(spark):
    from rowforge.session import scratch_path
    return lambda name: scratch_path(spark, "tests", name)
