import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from evstar.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="evstar-tests-")
    session = get_session(
        "local[4]",
        app="evstar-tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
