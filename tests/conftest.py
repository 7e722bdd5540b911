import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bercario.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = str(tmp_path_factory.mktemp("scratch"))
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(
        "tests",
        4,
        **{
            "spark.checkpoint.dir": scratch,
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": warehouse,
        },
    )
    yield session
    session.stop()


@pytest.fixture
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
