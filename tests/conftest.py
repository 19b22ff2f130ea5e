from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark import build_session  # noqa: E402
from tidemark.session import ROCKSDB_PROVIDER  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        4,
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
