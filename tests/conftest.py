"""Session and hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedsieve.operators.load import collapse_retries, typed_feed
from feedsieve.schemas import FEED_SCHEMA, INSTRUMENT_SCHEMA
from feedsieve.session import local_session

NOW = dt.datetime(2024, 5, 2, 12, 0)
AS_OF = "2024-05-02"
EARLIER = "2024-05-01 16:45:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = local_session(
        "tests",
        4,
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.default.parallelism": "2",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "5000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def instruments(spark) -> DataFrame:
    return spark.createDataFrame(
        [(1, "AAA", "EQUITY", "USD"), (2, "BBB", "BOND", "USD")], INSTRUMENT_SCHEMA
    )


# What a line of the feed says unless a test says otherwise.
SOUND = {
    "trade_id": None,
    "instrument_id": "1",
    "side": "BUY",
    "quantity": "8",
    "price": "12.5",
    "executed_at": EARLIER,
}


def row(trade_id: str | None, **changed) -> dict:
    """A sound line with changes, all as text; an empty string is a missing value."""
    unknown = changed.keys() - SOUND.keys()
    assert not unknown, unknown
    return SOUND | {"trade_id": trade_id} | {name: str(value) for name, value in changed.items()}


@pytest.fixture(scope="session")
def feed(spark):
    """The landed text feed of some lines."""

    def landed(*lines: dict, source: str = "feed.csv") -> DataFrame:
        origin = {"source_file": F.lit(source), "ingested_at": F.lit(NOW)}
        return spark.createDataFrame(list(lines), FEED_SCHEMA).withColumns(origin)

    return landed


@pytest.fixture(scope="session")
def load(feed):
    """The trade table that some lines come to."""
    return lambda *lines, **options: collapse_retries(typed_feed(feed(*lines, **options)))


def as_dict(df: DataFrame, key: str, value: str) -> dict:
    return {r[key]: r[value] for r in df.collect()}
