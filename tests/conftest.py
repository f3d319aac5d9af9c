import pytest

from bundlescope.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("bundlescope-tests")
    yield session
    session.stop()
