"""One local session for all tests."""

import pytest

from lumenreel.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("8", 4, "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
