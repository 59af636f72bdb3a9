from __future__ import annotations

import sys
from datetime import date, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfcast.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SERIES = "unique_id string, date date, y double"


@pytest.fixture
def series(spark):
    """Builds a panel from {id: {day offset: value}}, day 0 being 2024-01-01, a Monday."""

    def build(values: dict[str, dict[int, float | None]]):
        rows = [
            (name, date(2024, 1, 1) + timedelta(days=offset), y)
            for name, days in values.items()
            for offset, y in days.items()
        ]
        return spark.createDataFrame(rows, SERIES)

    return build


def day(offset: int) -> date:
    return date(2024, 1, 1) + timedelta(days=offset)
