import pytest

from docloom.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.host": "127.0.0.1"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
