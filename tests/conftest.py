import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ontarmac.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def flights(spark, folder):
    """The test flights, held so that each test need not join them again."""
    from ontarmac.checks import tables

    return tables.flights(spark, folder).cache()
