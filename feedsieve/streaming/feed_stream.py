"""The quality run on feed files as they arrive.

The stream's checkpoint remembers which files were read, so each start picks up
the new ones only. One micro-batch is one run named after its batch id: a batch
replayed after a failure overwrites its own quarantine partition and folds into
the same history row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedsieve.operators.labels import References
from feedsieve.operators.load import RESEND_ORDER, collapse_retries, typed_feed
from feedsieve.plans.quality_run import ALWAYS, run_quality
from feedsieve.rules import Rule
from feedsieve.sources.tables import QualityTables
from feedsieve.sources.trades import TradeTable


def check_arrivals(
    feed: DataFrame,
    references: References | None,
    tables: QualityTables,
    checkpoint: str,
    rules: Sequence[Rule] | None = None,
    name: str = "feed",
    as_of: str | dt.date | None = None,
    quarantine_when: str = ALWAYS,
) -> StreamingQuery:
    """Check everything that has arrived since the last call, then stop."""

    def check(rows: DataFrame, batch_id: int) -> None:
        # Read several times below; a stored batch is merged and typed once.
        path = f"{tables.path('arrivals')}/{name}-{batch_id}"
        collapse_retries(typed_feed(rows)).write.mode("overwrite").parquet(path)
        trades = rows.sparkSession.read.parquet(path)
        run_quality(
            trades,
            references,
            tables,
            rules,
            run_id=f"{name}-{batch_id}",
            as_of=as_of,
            quarantine_when=quarantine_when,
        )
        tables.advance_watermarks(trades)

    return (
        feed.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def settled_trades(feed: DataFrame, resend_within: str, late_by: str = "0 seconds") -> DataFrame:
    """The latest re-send of every trade of a stream, once no more can come.

    Re-sends of a trade that arrive (``ingested_at``) within ``resend_within`` of each other are one session, held as keyed
    state across micro-batches and across restarts: a maximum over a struct, one row per trade. When
    the watermark, ``late_by`` behind the newest arrival, has passed the end of the session its row is emitted
    and its state evicted, so state is bounded by the trades of that time span. A re-send that comes later is a new session,
    which the load's upsert lets replace the old one. Rows without a ``trade_id`` cannot be matched and pass at once.

    Over the same rows as a batch, with all re-sends within the span, it gives the rows of ``collapse_retries``.
    """
    typed = typed_feed(feed)
    ranked = [*RESEND_ORDER, *[c for c in typed.columns if c != "trade_id" and c not in RESEND_ORDER]]
    latest = (
        typed.withWatermark("ingested_at", late_by)
        .where(F.col("trade_id").isNotNull())
        .withColumn("_arrived", F.col("ingested_at"))
        .groupBy(F.session_window("_arrived", resend_within), "trade_id")
        .agg(F.max(F.struct(*[F.col(c) for c in ranked])).alias("_latest"))
    )
    settled = latest.select(
        *["trade_id" if c == "trade_id" else F.col(f"_latest.{c}").alias(c) for c in typed.columns]
    )
    return settled.unionByName(typed.where(F.col("trade_id").isNull()))


def load_settled(
    feed: DataFrame,
    table: TradeTable,
    checkpoint: str,
    resend_within: str,
    late_by: str = "0 seconds",
    name: str = "feed",
) -> StreamingQuery:
    """Load everything that has settled since the last call into the trade table, then stop.

    A micro-batch replayed after a failure is loaded under the same batch name and changes nothing.
    """

    def load(rows: DataFrame, batch_id: int) -> None:
        if not rows.isEmpty():
            table.load(rows, f"{name}-{batch_id}")

    return (
        settled_trades(feed, resend_within, late_by)
        .writeStream.foreachBatch(load)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
