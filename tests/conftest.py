import os
import sys

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
# Helper modules of the tests, and the repository itself.
sys.path[:0] = [_HERE, os.path.dirname(_HERE)]

from support import day_batch

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def batch():
    return day_batch(1, "2024-01-01")
