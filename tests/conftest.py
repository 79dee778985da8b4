import pytest

from refgauge.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
