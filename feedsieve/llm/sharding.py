"""Two-pass external shuffle of a table into shards.

Pass one scatters records uniformly into memory-sized buckets by a seeded hash;
pass two shuffles each bucket in memory (Fisher-Yates, seeded by the bucket) and
deals its records to the shards. The buckets lie one after another in one global
order, so record p goes to shard ``p % n`` at slot ``p // n``: row counts of shards
differ by one at most and slots have no gaps, whatever the number of buckets.

Records are ordered by id, length and checksum before they are shuffled, so a
repeated task gives the same result. A null text has no bytes. Rows without an id
scatter by their text. Repeated rows are rows of their own; a hundred thousand equal
rows meet in one bucket and are only dealt, not compared. An empty table
gives an empty result. Columns named ``shard`` or ``slot`` in the input are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.llm.common import free_name

BUCKET_BYTES = 8 << 20


def record_size(text_col: str = "text") -> Column:
    """UTF-8 bytes of the text, and one."""
    return F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 1


def shuffle_shards(
    docs: DataFrame,
    n_shards: int = 16,
    seed: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``; the driver holds eight bytes per bucket."""
    plain = docs.drop("shard", "slot")
    total = plain.agg(F.sum(record_size(text_col)).alias("b")).first()["b"] or 0
    n = max(1, math.ceil(total / bucket_bytes))
    keys = [F.lit(seed), F.col(id_col), F.crc32(F.coalesce(F.col(text_col), F.lit("")))]
    own = free_name(plain, "__bucket")
    scattered = plain.withColumn(own, F.pmod(F.xxhash64(*keys), F.lit(n)))
    offsets = np.zeros(n + 1, np.int64)
    for bucket, rows in scattered.groupBy(own).count().collect():
        offsets[bucket + 1] = rows
    before = docs.sparkSession.sparkContext.broadcast(np.cumsum(offsets))
    names = plain.columns
    id_at, text_at = names.index(id_col), names.index(text_col)

    def deal(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        table = table.drop_columns([own])
        text = table.column(text_at)
        order = pa.table(
            {
                "id": table.column(id_at),
                "size": pc.binary_length(text),
                "text": text,
            }
        )
        by_id = pc.sort_indices(
            order, sort_keys=[("id", "ascending"), ("size", "ascending"), ("text", "ascending")]
        )
        # permutation() is a Fisher-Yates shuffle
        rng = np.random.Generator(np.random.PCG64([seed, bucket]))
        table = table.take(by_id.take(pa.array(rng.permutation(table.num_rows))))
        place = before.value[bucket] + np.arange(table.num_rows, dtype=np.int64)
        return table.append_column("shard", pa.array((place % n_shards).astype(np.int32))).append_column(
            "slot", pa.array(place // n_shards)
        )

    schema = T.StructType(
        [*plain.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())]
    )
    return scattered.groupBy(own).applyInArrow(deal, schema)


def write_shards(shards: DataFrame, path: str) -> None:
    """One folder per shard, its records in slot order within each file."""
    shards.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
