"""Table layouts of the trade quality model.

Nothing is inferred at read time: the feed is all text, the trade table is
typed, and the two tables this package owns (``rejected_trades`` and
``validation_run``) have one fixed layout each.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The columns the trade table must have, in table order.
TRADE_COLUMNS = (
    "trade_id",
    "instrument_id",
    "side",
    "quantity",
    "price",
    "executed_at",
    "source_file",
    "ingested_at",
)

QUANTITY_TYPE = T.DecimalType(18, 4)
PRICE_TYPE = T.DecimalType(18, 6)
# Sums of quantity * price; wide enough that no intermediate rounding happens.
MONEY_TYPE = T.DecimalType(38, 10)

FEED_SCHEMA = T.StructType(
    [
        T.StructField("trade_id", T.StringType()),
        T.StructField("instrument_id", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("quantity", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("executed_at", T.StringType()),
    ]
)

INSTRUMENT_SCHEMA = T.StructType(
    [
        T.StructField("instrument_id", T.IntegerType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("asset_class", T.StringType()),
        T.StructField("currency", T.StringType()),
    ]
)


def trade_schema(timestamp: T.DataType | None = None) -> T.StructType:
    """Typed trade table. ``timestamp`` defaults to the session-zone type."""
    ts = timestamp or T.TimestampType()
    return T.StructType(
        [
            T.StructField("trade_id", T.StringType()),
            T.StructField("instrument_id", T.IntegerType()),
            T.StructField("side", T.StringType()),
            T.StructField("quantity", QUANTITY_TYPE),
            T.StructField("price", PRICE_TYPE),
            T.StructField("executed_at", ts),
            T.StructField("source_file", T.StringType()),
            T.StructField("ingested_at", ts),
        ]
    )


def rejected_schema(timestamp: T.DataType | None = None) -> T.StructType:
    """``rejected_trades``: the trade without its load time, plus why and when."""
    ts = timestamp or T.TimestampType()
    copied = [f for f in trade_schema(ts) if f.name != "ingested_at"]
    return T.StructType(
        copied
        + [
            T.StructField("reasons", T.ArrayType(T.StringType(), False)),
            T.StructField("run_id", T.StringType()),
            T.StructField("rejected_at", ts),
        ]
    )


def run_schema(timestamp: T.DataType | None = None) -> T.StructType:
    """``validation_run``: one state row per start and per finish of a run."""
    ts = timestamp or T.TimestampType()
    return T.StructType(
        [
            T.StructField("run_id", T.StringType()),
            T.StructField("started_at", ts),
            T.StructField("finished_at", ts),
            T.StructField("status", T.StringType()),
            T.StructField("rows_checked", T.LongType()),
            T.StructField("rows_rejected", T.LongType()),
            T.StructField("rules_total", T.IntegerType()),
            T.StructField("rules_failed", T.IntegerType()),
            T.StructField("details", T.StringType()),
        ]
    )


def watermark_schema(timestamp: T.DataType | None = None) -> T.StructType:
    """``etl_watermark``: newest execution time loaded so far, per source."""
    ts = timestamp or T.TimestampType()
    return T.StructType(
        [
            T.StructField("source_file", T.StringType()),
            T.StructField("high_watermark", ts),
        ]
    )


def counter_schema() -> T.StructType:
    """``partition_counters``: mergeable counters of a partition as of a load, by rule."""
    return T.StructType(
        [
            T.StructField("place", T.StringType()),
            T.StructField("load", T.LongType()),
            T.StructField("rows_checked", T.LongType()),
            T.StructField("failing", T.MapType(T.StringType(), T.LongType())),
            T.StructField("newest", T.MapType(T.StringType(), T.TimestampType())),
        ]
    )


def duplicate_schema() -> T.StructType:
    """``duplicate_changes``: by how much each load changed the number of duplicate rows."""
    return T.StructType([T.StructField("load", T.LongType()), T.StructField("duplicate_rows", T.LongType())])


def result_schema() -> T.StructType:
    """``rule_result``: what each rule found in each run."""
    return T.StructType(
        [
            T.StructField("run_id", T.StringType()),
            T.StructField("finished_at", T.TimestampType()),
            T.StructField("rule", T.StringType()),
            T.StructField("category", T.StringType()),
            T.StructField("scope", T.StringType()),
            T.StructField("success", T.BooleanType()),
            T.StructField("failing_rows", T.LongType()),
            T.StructField("observed", T.StringType()),
            T.StructField("rows_checked", T.LongType()),
        ]
    )
