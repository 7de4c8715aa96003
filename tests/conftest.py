from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daytally.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="daytally-tests-", dir="/tmp")
    session = get_session("local[4]", app="daytally-tests", shuffle_partitions=8,
                          conf={"spark.checkpoint.dir": f"{scratch}/checkpoints",
                                "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    yield session
    session.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="daytally-run-", dir="/tmp")
