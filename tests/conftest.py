import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from hitledger.session import build_session  # noqa: E402
from hitledger.sources import scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "hitledger-tests",
        master="local[8]",
        settings={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(home / "warehouse"),
            "spark.checkpoint.dir": str(home / "checkpoints"),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    scratch.clear(session)
    session.stop()
