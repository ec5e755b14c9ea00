from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.master": "local[8]",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = build_session("orderloom-tests", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
