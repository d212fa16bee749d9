import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.path.join(ROOT, "tests", "fakes") + os.pathsep + ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from gridloom.session import local_session

    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture()
def hot(spark):
    """Everything above 40 rows per key counts as hot, and nothing is small enough to broadcast whole."""
    from gridloom.operators import skew

    spark.conf.set("gridloom.hot.rows", "40")
    spark.conf.set("gridloom.broadcast.rows", "0")
    few, skew.KeyStats.few = skew.KeyStats.few, False
    yield
    skew.KeyStats.few = few
    spark.conf.unset("gridloom.hot.rows")
    spark.conf.unset("gridloom.broadcast.rows")
