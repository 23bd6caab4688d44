import pytest

from millrace.session import local_session
from tests.compare import connect

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "millrace-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)
