from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from slotcast import session  # noqa: E402
from slotcast.grid import Grid  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build(
        "slotcast-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def grid():
    """Quarter-hour grid with free floating-point values."""
    return Grid()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture
def series(spark):
    """Rows (time, key, value[, ingested]) as a frame on the contract columns."""

    def make(rows):
        full = [
            (at(r[0]), r[1], r[2], at(r[3]) if len(r) > 3 else at("2024-06-01T00:00:00"))
            for r in rows
        ]
        return spark.createDataFrame(
            full,
            "date_heure timestamp, region string, consommation double, _ingested_at timestamp",
        )

    return make
