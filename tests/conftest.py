import pytest

from tests.oracle import connect, make_spark

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = make_spark()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)
