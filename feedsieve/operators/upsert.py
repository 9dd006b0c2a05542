"""Keyed upserts as pure functions over DataFrames.

Parquet has no MERGE, so an upsert is an anti join plus a union. The existing
side has one row per key and is only shuffled when the incoming keys are too
many to broadcast: the caller says so after measuring them, or Spark decides by size.
``incoming`` must hold one row per key (see ``load.collapse_retries``). A row without a key replaces
nothing and is never dropped. What a repeated load does to such rows differs:

``upsert`` knows no batches. Of rows without a key that agree in every column as many stay as the
side that holds more of them has, so that loading the same rows again changes nothing.

``upsert_batch`` keeps the batch with each row without a key. Loading a batch again replaces the rows it brought
before; equal rows of two batches are two rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], few: bool = False
) -> DataFrame:
    """Incoming rows replace existing rows of the same key.

    With ``few`` the incoming keys, measured by the caller, are broadcast.
    """
    keys = list(keys)
    arriving = incoming.select(*existing.columns)
    keyed = arriving.dropna(subset=keys)
    replaced = keyed.select(*keys)
    kept = existing.dropna(subset=keys).join(
        F.broadcast(replaced) if few else replaced, keys, "left_anti"
    )
    nameless = _most_of_each(existing.where(unkeyed(keys)), arriving.where(unkeyed(keys)))
    return kept.select(*existing.columns).unionByName(keyed).unionByName(nameless)


def upsert_batch(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    batch_column: str,
    batch: str,
    few: bool = False,
) -> DataFrame:
    """Incoming rows replace existing rows of the same key, and those without a key that ``batch`` brought."""
    keys = list(keys)
    arriving = incoming.select(*existing.columns)
    replaced = arriving.dropna(subset=keys).select(*keys)
    named = existing.dropna(subset=keys).join(
        F.broadcast(replaced) if few else replaced, keys, "left_anti"
    )
    others = existing.where(unkeyed(keys) & ~F.col(batch_column).eqNullSafe(F.lit(batch)))
    return named.select(*existing.columns).unionByName(others).unionByName(arriving)


def _most_of_each(one: DataFrame, other: DataFrame) -> DataFrame:
    """Every row as often as the side has it that has it more often."""
    columns = [F.col(f"`{c}`") for c in one.columns]
    sides = one.select(*columns, F.lit(1).alias("__one"), F.lit(0).alias("__other")).unionByName(
        other.select(*columns, F.lit(0).alias("__one"), F.lit(1).alias("__other"))
    )
    times = F.greatest(F.sum("__one"), F.sum("__other"))
    counted = sides.groupBy(*columns).agg(times.alias("__times"))
    return counted.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*columns)


def unkeyed(keys: Sequence[str]) -> Column:
    """Rows lacking part of their key."""
    lacking = F.lit(False)
    for key in keys:
        lacking = lacking | F.col(key).isNull()
    return lacking
