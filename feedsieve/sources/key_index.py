"""Which keys a table holds, and in which partition, by hash bucket.

One row per key and load, in a table bucketed by the key: a join with it moves the other, smaller side only.
A Bloom filter per bucket answers first. It is made of 64-bit words: a key sets four bits of
one word, found by its hash, so a test is one equality join. Keys that fail it are certainly new and never reach the
index; about one in forty of the others passes in vain at ten bits a key.

Rows are only ever added, each with the number of its load. Loads that were never finished are left out by their number,
so an interrupted load that is repeated under a new one does no harm. The bucket count and the
words of a filter are fixed when the index is made; ``expected_keys`` sets them.
"""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedsieve.operators.references import small_enough
from feedsieve.sources.files import make_folder, place_text, read_text

BITS_PER_KEY = 10
KEYS_PER_BUCKET = 4_000_000
PROBES = 4


class KeyIndex:
    """Index of ``key`` with the partition value ``place`` (as text) of each."""

    def __init__(
        self, spark: SparkSession, path: str, key: str = "trade_id", expected_keys: int = 1_000_000, buckets: int | None = None
    ):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.buckets = buckets or max(1, math.ceil(expected_keys / KEYS_PER_BUCKET))
        self.words = max(64, math.ceil(expected_keys * BITS_PER_KEY / self.buckets / 64))
        self.ready = False
        self.table = "feedsieve_keys_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
    def ensure(self) -> None:
        """Make the index, or take up one that is there with the sizes it was made with."""
        if self.ready:
            return
        settings = f"{self.path}/sizes.json"
        sizes = json.dumps({"buckets": self.buckets, "words": self.words})
        make_folder(self.spark, self.path)
        if not place_text(self.spark, settings, sizes):
            sizes = read_text(self.spark, settings)
        self.buckets, self.words = (json.loads(sizes)[name] for name in ("buckets", "words"))
        # Catalogs may be new in each session; the folder is not.
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (`{self.key}` STRING, place STRING, load BIGINT) USING parquet "
            f"CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}/keys'"
        )
        empty = self.spark.createDataFrame([], "cell long, bits long, load long")
        empty.write.mode("ignore").parquet(f"{self.path}/filters")
        self.ready = True

    def rows(self) -> DataFrame:
        self.ensure()
        return self.spark.table(self.table)

    def _cell(self) -> Column:
        """The filter word of a key, counted through all buckets."""
        bucket = F.pmod(F.hash(self.key), F.lit(self.buckets)).cast("long")
        return bucket * self.words + F.pmod(F.xxhash64(self.key), F.lit(self.words))

    def _mask(self) -> Column:
        """The bits of a key in its word."""
        spread = F.xxhash64(F.col(self.key), F.lit("bits"))
        mask = F.lit(0).cast("long")
        for probe in range(PROBES):
            place = F.shiftrightunsigned(spread, 6 * probe).bitwiseAND(F.lit(63)).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
        return mask

    def add(self, keyed: DataFrame, place: Column, load: int) -> None:
        """Enter the keys of a load (null ones are left out) with where their rows lie."""
        self.ensure()
        rows = keyed.where(F.col(self.key).isNotNull()).select(
            self.key, place.alias("place"), F.lit(load).cast("long").alias("load")
        )
        # One file per bucket: rows come placed as the table is.
        rows.repartition(self.buckets, self.key).write.insertInto(self.table)
        words = (
            rows.select(self._cell().alias("cell"), self._mask().alias("mask"))
            .groupBy("cell")
            .agg(F.bit_or("mask").alias("bits"))
            .withColumn("load", F.lit(load).cast("long"))
        )
        words.write.mode("append").parquet(f"{self.path}/filters")

    def maybe_known(self, keys: DataFrame) -> DataFrame:
        """Distinct non-null keys that the filters do not rule out."""
        self.ensure()
        wanted = keys.where(F.col(self.key).isNotNull()).select(self.key).distinct()
        cells = wanted.select(self.key, self._cell().alias("cell"), self._mask().alias("mask"))
        if small_enough(wanted):
            cells = F.broadcast(cells)
        words = self.spark.read.schema("cell long, bits long, load long").parquet(f"{self.path}/filters")
        met = words.join(cells, "cell")
        # The words of several loads add up.
        return (
            met.groupBy(self.key, "mask")
            .agg(F.bit_or("bits").alias("bits"))
            .where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
            .select(self.key)
        )

    def entries(self, keys: DataFrame, loads: DataFrame) -> DataFrame:
        """The index rows of the given keys from finished loads (``load``): key, place, load.

        Joined bucket by bucket: the keys are moved to the buckets, index rows stay where they are. ``loads``
        has a row per load, like the run history.
        """
        known = self.maybe_known(keys)
        return (
            self.rows()
            .join(known.hint("shuffle_hash"), self.key, "left_semi")
            .join(F.broadcast(loads.select(F.col("load").cast("long").alias("load"))), "load", "left_semi")
            .select(self.key, "place", "load")
        )

    def newest(self, keys: DataFrame, loads: DataFrame) -> DataFrame:
        """Where each known key lies now: its entry of the latest load."""
        entries = self.entries(keys, loads)
        return (
            entries.groupBy(self.key)
            .agg(F.max(F.struct("load", "place")).alias("last"))
            .select(self.key, F.col("last.place").alias("place"))
        )

    def counts(self, keys: DataFrame, loads: DataFrame) -> DataFrame:
        """How often each known key was entered: of use where a load adds rows and replaces none."""
        return self.entries(keys, loads).groupBy(self.key).agg(F.count(F.lit(1)).alias("n"))


def duplicates_after(index: KeyIndex, arrived: DataFrame, loads: DataFrame) -> DataFrame:
    """Keys of a batch that occur more than once in it and in the indexed loads together: key, before, n."""
    own = arrived.where(F.col(index.key).isNotNull()).groupBy(index.key).agg(F.count(F.lit(1)).alias("own"))
    before = index.counts(arrived, loads).withColumnRenamed("n", "before")
    none = F.lit(0).cast("long")
    return (
        own.join(before, index.key, "left")
        .select(index.key, F.coalesce("before", none).alias("before"), (F.col("own") + F.coalesce("before", none)).alias("n"))
        .where("n > 1")
    )
