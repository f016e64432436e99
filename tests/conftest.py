from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from wayfare.session import build_session

    work = tempfile.mkdtemp(prefix="run-")
    os.makedirs(f"{work}/events")
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": f"{work}/checkpoint",
            "spark.sql.warehouse.dir": f"{work}/warehouse",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.dir": f"{work}/events",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    session.event_dir = f"{work}/events"
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return DATA


@pytest.fixture(scope="session")
def duck(data):
    from tests.compare import connect

    return connect(data)


def rows(df) -> list[tuple]:
    """Rows in a fixed order, for comparing multisets."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
