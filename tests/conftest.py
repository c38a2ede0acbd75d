import pytest

from meshloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "4g", **{"spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}", "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()
