"""The trade table, stored by day and loaded by upsert, one version per load.

A load touches the days its rows belong to and those that hold an older version of
them, which the key index names. Only these are read and written again, as a new version that one
rename makes current: a load stopped at any point leaves the table as it was, and a repeat of it finds the
same days and ends alike. Earlier versions stay readable until they are forgotten.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.operators.load import collapse_retries, late_by_source, newer_by_source, typed_feed
from feedsieve.operators.pnl import trade_date
from feedsieve.operators.references import small_enough
from feedsieve.operators.report import feed_freshness
from feedsieve.operators.upsert import upsert_batch
from feedsieve.rules import Rule
from feedsieve.schemas import trade_schema
from feedsieve.sources.key_index import KeyIndex
from feedsieve.sources.versions import NO_VALUE, Manifest, VersionedTable, partition_text

DAY = "trade_date"
BATCH = "load_batch"


@dataclass(frozen=True)
class LoadOutcome:
    """What became of every row of a feed.

    ``rows_in`` is the sum of the next four. ``days`` (one row per calendar day) are
    those the load touched, for ``refresh_daily`` and ``check_days``; ``version`` is that of the table it made.
    """

    rows_in: int
    rows_late: int
    rows_upserted: int
    rows_superseded: int
    rows_unkeyed: int
    days: DataFrame
    version: int


class TradeTable:
    """Handle on the trade table and the batches loaded into it.

    ``expected_keys`` sizes the key index when the table is first loaded.
    """

    def __init__(
        self, spark: SparkSession, root: str, timestamp: T.DataType | None = None, expected_keys: int = 1_000_000
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.timestamp = timestamp
        self.layout = trade_schema() if timestamp is None else trade_schema(timestamp)
        # Rows without an id belong to the batch that brought them.
        stored = T.StructType([*self.layout.fields, T.StructField(BATCH, T.StringType()), T.StructField(DAY, T.DateType())])
        self.store = VersionedTable(spark, f"{self.root}/trade", stored, DAY)
        self.index = KeyIndex(spark, f"{self.root}/trade_keys", expected_keys=expected_keys)

    def rows(self, version: int | None = None) -> DataFrame:
        """The trades, in the layout of ``trade_schema``; as of an earlier version if one is given."""
        return self.store.rows(version).select(*self.layout.fieldNames())

    def freshness(self, rule: Rule, as_of: str | None = None) -> DataFrame:
        """``feed_freshness`` from the newest stored day alone, with the number of rows from the manifest."""
        newest = self.store.greatest(rule.columns[0])
        return feed_freshness(newest, rule, as_of).withColumn("rows_checked", F.lit(self.store.row_count()).cast("long"))

    def loads(self) -> DataFrame:
        """The finished loads, a row each."""
        return self.spark.createDataFrame([(v,) for v in self.store.versions()], "load long")

    def load(self, feed: DataFrame, batch: str, marks: DataFrame | None = None) -> LoadOutcome:
        """Type a feed, merge its re-sends and upsert it.

        The merged feed is stored once below ``batches`` under the name ``batch`` and read
        from there. A column the feed lacks is loaded as nulls. With ``marks`` (stored watermarks) rows older than the
        mark of their own source are left out and counted as late.

        Rows without a ``trade_id`` replace those the same batch brought before, and are added to all others.
        """
        before = self.store.manifest()
        typed = typed_feed(feed, self.timestamp, complete=True)
        wanted = typed if marks is None else newer_by_source(typed, marks)
        folder = f"{self.root}/batches/{batch}"
        merged = collapse_retries(wanted).withColumn(BATCH, F.when(F.col("trade_id").isNull(), F.lit(batch)))
        merged.withColumn(DAY, trade_date()).write.mode("overwrite").parquet(folder)
        arrived = self.spark.read.schema(self.store.schema).parquet(folder)

        rows_in = typed.count()
        if marks is None:
            rows_late = 0
        else:
            rows_late = late_by_source(typed, marks).agg(F.coalesce(F.sum("late_rows"), F.lit(0))).first()[0]
        counts = arrived.agg(F.count("trade_id").alias("keyed"), F.count(F.lit(1)).alias("n")).first()
        few = small_enough(arrived.select("trade_id"))
        # A row per day at most.
        mine = {r[0]: r["nameless"] for r in self._days_of(arrived).collect()}
        left = {r["place"] for r in self.index.newest(arrived, self.loads()).select("place").distinct().collect()}
        former = set(before.notes.get(batch, []))
        values = sorted(mine.keys() | left | former)

        version = self.store.begin()
        written = self.store.write(version, self.merged(before, arrived, values, batch, few))
        self.index.add(arrived, partition_text(DAY), version)
        nameless = sorted(value for value, has in mine.items() if has)
        notes = {b: days for b, days in before.notes.items() if b != batch} | ({batch: nameless} if nameless else {})
        self.store.commit(before, version, written, values, notes)

        days = [(None if v == NO_VALUE else v,) for v in values]
        return LoadOutcome(
            rows_in=rows_in,
            rows_late=rows_late,
            rows_upserted=counts["keyed"],
            rows_superseded=rows_in - rows_late - counts["n"],
            rows_unkeyed=counts["n"] - counts["keyed"],
            days=self.spark.createDataFrame(days, "day string").select(F.col("day").cast("date").alias(DAY)),
            version=version,
        )

    def _days_of(self, arrived: DataFrame) -> DataFrame:
        return arrived.groupBy(partition_text(DAY).alias("value")).agg(
            F.bool_or(F.col("trade_id").isNull()).alias("nameless")
        )

    def merged(self, before: Manifest, arrived: DataFrame, values: list[str], batch: str, few: bool) -> DataFrame:
        """The days with the given folder names after the upsert; no other day is read."""
        stored = self.store.rows_of(before, values)
        return upsert_batch(stored, arrived, ["trade_id"], BATCH, batch, few)
