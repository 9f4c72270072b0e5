import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clearshelf.session import local_session  # noqa: E402

SF_DIR = os.environ.get("CLEARSHELF_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ws(spark):
    from clearshelf.plans.workspace import workspace

    return workspace(spark, SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
