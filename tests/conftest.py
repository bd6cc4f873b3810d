import pytest

from clipwell.session import spark_session


@pytest.fixture(scope="session")
def spark():
    return spark_session("tests", 8)
