import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from churnlake.operators.cleaning import clean_customers  # noqa: E402
from churnlake.session import local_session, release_stages, stage  # noqa: E402
from churnlake.sources.telco import raw_feed  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    release_stages(session)
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    return stage(raw_feed(spark, MEDIUM), "test-raw")


@pytest.fixture(scope="session")
def customers(raw):
    return stage(clean_customers(raw), "test-customers")
