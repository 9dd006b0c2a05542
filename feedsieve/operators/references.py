"""Existence of a key in a reference table, without shuffling the fact table.

The reference data lags and grows, so its size is measured before anything is
broadcast. Three exact ways, tried in order:

1. The reference keys are few: broadcast them and left-join.
2. They are not: find the *unknown* keys instead. ``distinct`` combines on the
   map side, so a key holding a third of the rows costs one row per task, and
   the anti join runs on distinct keys only. Unknown keys are normally few;
   they are broadcast after being counted.
3. Both sets are large: a shuffled left join. Null keys, which can match
   nothing, are spread over many partitions, and adaptive execution splits the
   partitions of hot keys (a left outer join may be split on its left side).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedsieve.functions.predicates import quoted
from feedsieve.rules import EXISTS_IN, Rule

# Bounds of a broadcast key set. Four million integer keys make a hash table of
# roughly 200 MB, which a driver and every executor can hold.
MAX_BROADCAST_KEYS = 4_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def reference_keys(reference: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    """Distinct non-null keys, so that a join with them never multiplies rows."""
    return (
        reference.where(F.col(key).isNotNull()).select(F.col(key).alias(alias or key)).distinct()
    )


def small_enough(
    keys: DataFrame,
    max_keys: int = MAX_BROADCAST_KEYS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Measure what would be broadcast against the bounds (one small job).

    The size is taken over the text form of all columns of ``keys``.
    """
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in keys.columns]
    size = keys.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(sum(widths[1:], widths[0])), F.lit(0)).alias("bytes"),
    ).first()
    return size["n"] <= max_keys and size["bytes"] <= max_bytes


def mark_unknown_keys(
    df: DataFrame,
    rules: Iterable[Rule],
    references: Mapping[str, DataFrame],
    max_keys: int = MAX_BROADCAST_KEYS,
) -> tuple[DataFrame, dict[str, str]]:
    """Join what the ``exists_in`` rules need; returns the SQL flag of each rule.

    The result has helper columns beside those of ``df``; callers select them
    away. Rules on the same column and reference share one join.
    """
    flags: dict[str, str] = {}
    joined: dict[tuple, str] = {}
    original = df.columns
    for rule in rules:
        if rule.kind != EXISTS_IN:
            continue
        name, key = rule.reference
        if name not in references:
            raise ValueError(f"rule {rule.name} needs the reference table {name}")
        lookup = (rule.columns[0], name, key)
        if lookup not in joined:
            df, joined[lookup] = _mark(
                df, original, rule.columns[0], references[name], key, len(joined), max_keys
            )
        flags[rule.name] = joined[lookup]
    return df, flags


def _mark(
    df: DataFrame,
    original: list[str],
    column: str,
    reference: DataFrame,
    key: str,
    position: int,
    max_keys: int,
) -> tuple[DataFrame, str]:
    alias = f"_ref_{position}"
    value = F.col(column)
    # The raw key column bounds the distinct keys from above and costs less to measure.
    fits = small_enough(reference.select(key), max_keys)
    keys = reference_keys(reference, key, alias)
    if fits:
        out = df.join(F.broadcast(keys), value == F.col(alias), "left")
        return out, f"{quoted(column)} IS NOT NULL AND {alias} IS NULL"

    seen = df.where(value.isNotNull()).select(value.alias(alias)).distinct()
    # Found once for the measure and once for the join, which needs no folder to keep it in.
    unknown = seen.join(keys, alias, "left_anti")
    if small_enough(unknown, max_keys):
        out = df.join(F.broadcast(unknown), value == F.col(alias), "left")
        return out, f"{alias} IS NOT NULL"

    # Rows without a key match nothing; a hash of the whole row places them instead.
    spread, spread_key = f"_spread_{position}", f"_spread_key_{position}"
    placed = df.withColumn(
        spread, F.when(value.isNull(), F.xxhash64(*original)).otherwise(F.xxhash64(value))
    )
    unknown = unknown.withColumn(spread_key, F.xxhash64(alias))
    out = placed.join(
        unknown, (value == F.col(alias)) & (F.col(spread) == F.col(spread_key)), "left"
    )
    return out, f"{alias} IS NOT NULL"
