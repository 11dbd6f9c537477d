import pytest

from corpus_audit.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", cpus="4", shuffle_partitions=4)
