import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.oracle import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = spark_session()
    session.sparkContext.setLogLevel("OFF")
    from gapweave.storage import ship_package

    ship_package(session)
    yield session
    session.stop()
