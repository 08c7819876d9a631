import pytest

from landgauge.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(autouse=True)
def _free_cache(spark):
    yield
    spark.catalog.clearCache()
