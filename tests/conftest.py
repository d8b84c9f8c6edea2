from __future__ import annotations

import sys
from datetime import date, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quotidian import schemas  # noqa: E402
from quotidian.session import local_session  # noqa: E402
from quotidian.sources import catalog  # noqa: E402
from quotidian.sources.lake import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        "tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    """A lake of its own, whose tables no later test finds registered."""
    own = Lake(str(tmp_path / "lake"))
    yield own
    for schema, table in catalog.lake_tables(own):
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{table}")


@pytest.fixture
def bars(spark):
    """(ticker, date, close) from closes per ticker, on consecutive days that end on a date."""

    def make(closes: dict[str, list], end: date = date(2024, 6, 28)):
        rows = [
            (ticker, end - timedelta(days=len(values) - 1 - i), value)
            for ticker, values in closes.items()
            for i, value in enumerate(values)
        ]
        return spark.createDataFrame(rows, "ticker string, date date, close double")

    return make


@pytest.fixture
def prices(spark):
    """Full curated rows; each row is a dict of what differs from a plain bar."""

    def make(*rows: dict):
        plain = {
            "date": date(2024, 6, 28), "ticker": "A", "open": 10.0, "high": 11.0, "low": 9.0,
            "close": 10.0, "volume": 100, "source": "stooq",
        }
        data = [tuple({**plain, **r}[c] for c in schemas.DAILY_PRICES.names) for r in rows]
        return spark.createDataFrame(data, schemas.DAILY_PRICES)

    return make


@pytest.fixture
def universe(spark):
    return spark.createDataFrame(
        [("A", "Alpha", "Tech", "1"), ("B", "Beta", "Tech", "2"), ("C", "Gamma", "Energy", "3"),
         ("D", "Delta", None, "4")],
        schemas.UNIVERSE,
    )


def column(df, name, order=("date",)):
    return [r[name] for r in df.orderBy(*order).collect()]
