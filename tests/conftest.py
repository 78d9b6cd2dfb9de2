from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tideline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, "tests", **{"spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")), "spark.driver.memory": "8g",
                       "spark.sql.streaming.metricsEnabled": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
