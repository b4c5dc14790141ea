import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickweek.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="tickweek-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="tickweek-tests-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture()
def scratch(spark):
    from tickweek.session import scratch_path

    return lambda name="t": scratch_path(spark, name)


@pytest.fixture(scope="module", autouse=True)
def own_cache():
    """What a module's tests cache goes with them: later plans would read it in place of the files."""
    yield
    session = SparkSession.getActiveSession()
    if session is not None:
        session.catalog.clearCache()
