import pytest

from clausewise.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="clausewise-tests", memory="4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
