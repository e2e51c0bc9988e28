import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quayload.session import local_session  # noqa: E402


# Column expressions need a running session, also those made while tests are collected.
SESSION = local_session(8)
SESSION.sparkContext.setLogLevel("OFF")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")
