"""Validation of the partitions a load touched.

Counters of a partition are stored with the number of the load that made them and merged: counts add up and the newest
time is the maximum, so untouched partitions need not be read again. A later load's counters of a partition replace
earlier ones when they are read, so storing them again does no harm.
Uniqueness does not merge by partition. Either the keys of the touched partitions are compared with
the whole table, reading only its key column, or each load stores by how much it changed the number of duplicates,
which a key index tells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedsieve.operators.labels import References
from feedsieve.operators.references import small_enough
from feedsieve.operators.report import counters
from feedsieve.rules import FRESH, Rule, row_rules


def touched_partitions(df: DataFrame, touched: DataFrame, partition: str) -> DataFrame:
    """Rows of the partitions listed in ``touched``.

    On a table partitioned by that column the join by equality prunes whole
    folders at run time. Undated rows are read from their own folder, if the null
    partition is among those touched.
    """
    wanted = touched.select(F.col(partition).alias("_wanted")).distinct()
    dated = df.join(
        wanted.where("_wanted IS NOT NULL"), F.col(partition) == F.col("_wanted"), "left_semi"
    )
    mark = F.coalesce(F.col(partition).cast("string"), F.lit("none"))
    none = wanted.where("_wanted IS NULL").select(
        F.coalesce(F.col("_wanted").cast("string"), F.lit("none")).alias("_none")
    )
    undated = df.where(F.col(partition).isNull()).join(none, mark == F.col("_none"), "left_semi")
    return dated.unionByName(undated)


def partition_counters(
    df: DataFrame, references: References | None, rules: Sequence[Rule], partition: str
) -> DataFrame:
    """Mergeable counters of each partition."""
    return counters(df, references, rules, by=[partition])


def replace_partitions(stored: DataFrame, fresh: DataFrame, partition: str) -> DataFrame:
    """Stored counters with those of re-validated partitions replaced."""
    renewed = fresh.select(F.col(partition).alias("_renewed"))
    kept = stored.join(renewed, F.col(partition).eqNullSafe(F.col("_renewed")), "left_anti")
    return kept.unionByName(fresh)


def touched_duplicates(whole: DataFrame, touched: DataFrame, key: str = "trade_id") -> DataFrame:
    """Duplicate keys that a load may have caused, counted over the whole table.

    The keys of the load filter the table before anything is counted; they are measured and
    broadcast if they are few. With a key index ``key_index.duplicates_after`` reads less.
    """
    given = touched.where(F.col(key).isNotNull()).select(key)
    keys = given.distinct()
    if small_enough(given):
        keys = F.broadcast(keys)
    return (
        whole.select(key)
        .join(keys, key, "left_semi")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def counter_state(counted: DataFrame, rules: Sequence[Rule], place: Column, load: int) -> DataFrame:
    """``partition_counters`` rows in the stored layout, one row per partition whatever the rules are."""
    names = [r.name for r in row_rules(rules) if f"n_{r.name}" in counted.columns]
    fresh = [r.name for r in rules if r.kind == FRESH and f"newest_{r.name}" in counted.columns]

    def mapped(prefix: str, chosen: Sequence[str], kind: str) -> Column:
        entries = [e for n in chosen for e in (F.lit(n), F.col(f"{prefix}{n}").cast(kind))]
        return F.create_map(*entries).cast(f"map<string,{kind}>")

    return counted.select(
        place.alias("place"),
        F.lit(load).cast("long").alias("load"),
        "rows_checked",
        mapped("n_", names, "bigint").alias("failing"),
        mapped("newest_", fresh, "timestamp").alias("newest"),
    )


def emptied_state(places: DataFrame, load: int) -> DataFrame:
    """State rows of partitions (``place``) that a load left without rows."""
    return places.select(
        "place",
        F.lit(load).cast("long").alias("load"),
        F.lit(0).cast("long").alias("rows_checked"),
        F.create_map().cast("map<string,bigint>").alias("failing"),
        F.create_map().cast("map<string,timestamp>").alias("newest"),
    )


def fold_state(state: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row of counters of the whole table, from each partition's latest load.

    Read from the state alone; a rule that no load has counted yet shows as null, not as zero.
    """
    latest = state.groupBy("place").agg(
        F.max_by(F.struct("rows_checked", "failing", "newest"), "load").alias("s")
    ).select("s.*")
    sums = [F.coalesce(F.sum("rows_checked"), F.lit(0)).cast("long").alias("rows_checked")]
    # An empty partition fails nothing, whether or not the rule was counted there.
    absent = F.when(F.col("rows_checked") == 0, F.lit(0).cast("long"))
    for rule in row_rules(rules):
        value = F.coalesce(F.col("failing")[rule.name], absent)
        whole = F.when(F.count(F.lit(1)) == F.count(value), F.coalesce(F.sum(value), F.lit(0).cast("long")))
        sums.append(whole.alias(f"n_{rule.name}"))
    sums += [F.max(F.col("newest")[r.name]).alias(f"newest_{r.name}") for r in rules if r.kind == FRESH]
    return latest.agg(*sums)


def duplicate_change(duplicates: DataFrame, load: int) -> DataFrame:
    """One row: by how much a load changed the rows in duplicate groups.

    ``duplicates`` has, per repeated key, its rows ``before`` the load and ``n`` with it (``key_index.duplicates_after``).
    """
    counted_before = F.when(F.col("before") > 1, F.col("before")).otherwise(0)
    return duplicates.agg(
        F.lit(load).cast("long").alias("load"),
        F.coalesce(F.sum(F.col("n") - counted_before), F.lit(0)).cast("long").alias("duplicate_rows"),
    )
