import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tripwx.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="tripwx-tests")
    yield s


@pytest.fixture(autouse=True, scope="module")
def _uncached(spark):
    """What the tests of one file cache is gone when the next file begins."""
    yield
    spark.catalog.clearCache()


@pytest.fixture()
def tmp_dir(spark):
    from tripwx.session import scratch_path
    return scratch_path(spark, "test")
