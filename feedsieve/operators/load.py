"""Feed load: typing, merging of re-sent trades, incremental selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.operators.references import small_enough
from feedsieve.operators.upsert import upsert
from feedsieve.schemas import trade_schema

RESEND_ORDER = ("executed_at", "instrument_id", "side", "quantity", "price")


def typed_feed(
    feed: DataFrame, timestamp: T.DataType | None = None, complete: bool = False
) -> DataFrame:
    """All-text feed to the typed trade layout.

    An empty string is a missing value. Text that does not parse also becomes
    null, so the completeness rules report it and the batch goes on. A column the feed lacks is
    left out, for drift to be seen, or with ``complete`` filled with nulls, for loading it.
    """
    typed = []
    for field in trade_schema(timestamp):
        if field.name not in feed.columns:
            if complete:
                typed.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        if isinstance(feed.schema[field.name].dataType, T.StringType):
            value = F.nullif(F.col(field.name), F.lit(""))
            if not isinstance(field.dataType, T.StringType):
                value = value.try_cast(field.dataType)
        else:
            value = F.col(field.name).cast(field.dataType)
        typed.append(value.alias(field.name))
    return feed.select(*typed)


def latest_per_key(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per non-null key: the greatest by ``order``, nulls last, then by the other columns.

    A maximum over a struct combines on the map side, so a key re-sent a billion
    times reaches its reducer as one row per task. The result stays placed by
    key, which a following upsert on that key uses without another shuffle.
    """
    ranked = [*order, *[c for c in rows.columns if c != key and c not in order]]
    return (
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(*ranked)).alias("_latest"))
        .select(*[key if c == key else F.col(f"_latest.{c}").alias(c) for c in rows.columns])
    )


def collapse_retries(
    trades: DataFrame,
    key: str = "trade_id",
    order: Sequence[str] = RESEND_ORDER,
    measure: bool = False,
) -> DataFrame:
    """The latest re-send of every trade.

    Rows without a key cannot be matched with each other and all stay; their
    filter reaches the scan, which skips every row group without null keys.

    With ``measure`` the keys are counted first, which reads the key column alone. If those that repeat are few
    enough to be broadcast, only their rows are sorted and moved; all others stay where they are. It costs a job, so
    ``trades`` should be a stored table.
    """
    unmatched = trades.where(F.col(key).isNull())
    if measure:
        repeated = trades.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        repeated = repeated.where("_n > 1").select(key)
        if small_enough(repeated):
            marks = F.broadcast(repeated.withColumn("_repeated", F.lit(True)))
            marked = trades.where(F.col(key).isNotNull()).join(marks, key, "left")
            again = marked.where("_repeated").select(*trades.columns)
            once = marked.where("_repeated IS NULL").select(*trades.columns)
            return latest_per_key(again, key, order).unionByName(once).unionByName(unmatched)
    return latest_per_key(trades, key, order).unionByName(unmatched)


def high_watermark(trades: DataFrame, column: str = "executed_at") -> DataFrame:
    """One row, one column: the newest value loaded so far."""
    return trades.agg(F.max(column).alias("high_watermark"))


def source_watermarks(trades: DataFrame) -> DataFrame:
    """Newest execution time per source, in the ``etl_watermark`` layout."""
    return trades.groupBy("source_file").agg(F.max("executed_at").alias("high_watermark"))


def advance_watermarks(marks: DataFrame, trades: DataFrame) -> DataFrame:
    """Stored watermarks raised by a batch; they never move back."""
    return (
        marks.unionByName(source_watermarks(trades))
        .groupBy("source_file")
        .agg(F.max("high_watermark").alias("high_watermark"))
    )


def newer_than(
    trades: DataFrame, watermark: Column | None, column: str = "executed_at"
) -> DataFrame:
    """Rows from the watermark on. Rows without a time cannot be placed and stay in.

    A trade at the very mark may be new, and loading it again does no harm.

    ``watermark`` is a literal or a scalar subquery (``high_watermark(t).scalar()``);
    a null one, from an empty table, loads everything.
    """
    if watermark is None:
        return trades
    value = F.col(column)
    return trades.where(value.isNull() | watermark.isNull() | (value >= watermark))


def late_rows(
    trades: DataFrame, watermark: Column, column: str = "executed_at"
) -> DataFrame:
    """Rows per source that an incremental load leaves out, and their oldest time."""
    return (
        trades.where(F.col(column) < watermark)
        .groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("late_rows"), F.min(column).alias("oldest"))
    )


def _own_mark(trades: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows with the stored mark of their own source as ``_mark``; null without one.

    There is a mark per source, normally few: measured, then broadcast. Otherwise the rows are shuffled by source, hot
    sources split by adaptive execution.
    """
    own = marks.groupBy(F.col("source_file").alias("_source")).agg(F.max("high_watermark").alias("_mark"))
    if small_enough(marks.select("source_file")):
        own = F.broadcast(own)
    return trades.join(own, F.col("source_file").eqNullSafe(F.col("_source")), "left")


def newer_by_source(trades: DataFrame, marks: DataFrame, column: str = "executed_at") -> DataFrame:
    """Rows from the mark of their own source on (``source_file``, ``high_watermark``).

    A slow source is not held to the mark of a fast one, and one without a mark is loaded in full. Rows
    without a time cannot be placed and stay in.
    """
    value, mark = F.col(column), F.col("_mark")
    kept = _own_mark(trades, marks).where(value.isNull() | mark.isNull() | (value >= mark))
    return kept.select(*trades.columns)


def late_by_source(trades: DataFrame, marks: DataFrame, column: str = "executed_at") -> DataFrame:
    """Rows per source that ``newer_by_source`` leaves out, the mark they miss and their oldest time."""
    return (
        _own_mark(trades, marks)
        .where(F.col(column) < F.col("_mark"))
        .groupBy("source_file")
        .agg(
            F.count(F.lit(1)).alias("late_rows"),
            F.min(column).alias("oldest"),
            F.max("_mark").alias("high_watermark"),
        )
    )


def load_trades(
    existing: DataFrame,
    feed: DataFrame,
    incremental: bool = False,
    timestamp: T.DataType | None = None,
    marks: DataFrame | None = None,
) -> DataFrame:
    """The trade table after loading a feed: type, select, merge re-sends, upsert.

    An incremental load leaves out what is older than the mark of its own source, corrections of
    older trades included (see ``late_by_source``), so it has to be asked for. The marks are
    read from ``marks``, the stored ``etl_watermark``; without it the trade table is scanned. A column the feed
    lacks is loaded as nulls.
    """
    incoming = typed_feed(feed, timestamp, complete=True)
    if incremental:
        incoming = newer_by_source(incoming, source_watermarks(existing) if marks is None else marks)
    arrived = collapse_retries(incoming)
    return upsert(existing, arrived, ["trade_id"], small_enough(incoming.select("trade_id")))


def load_balance(existing: DataFrame, feed: DataFrame, timestamp: T.DataType | None = None) -> DataFrame:
    """One row that accounts for every row of a feed.

    ``rows_in`` is ``rows_upserted`` + ``rows_superseded`` + ``rows_unkeyed``; of the upserted
    ones ``rows_new`` have a key the table lacked.
    """
    incoming = typed_feed(feed, timestamp)
    keys = incoming.groupBy("trade_id").agg(F.count(F.lit(1)).alias("n"))
    known = existing.where("trade_id IS NOT NULL").select("trade_id", F.lit(True).alias("known"))
    return (
        keys.join(known, "trade_id", "left")
        .agg(
            F.expr("coalesce(sum(n), 0) AS rows_in"),
            F.expr("count(trade_id) AS rows_upserted"),
            F.expr("coalesce(sum(IF(trade_id IS NOT NULL, n - 1, 0)), 0) AS rows_superseded"),
            F.expr("coalesce(sum(IF(trade_id IS NULL, n, 0)), 0) AS rows_unkeyed"),
            F.expr("count_if(trade_id IS NOT NULL AND known IS NULL) AS rows_new"),
        )
    )
