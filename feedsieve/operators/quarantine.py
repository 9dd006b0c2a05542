"""Quarantine: failing rows copied aside with every reason, and what they add up to."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedsieve.functions.predicates import literal, quoted
from feedsieve.operators.labels import References, failing_rows, offenders
from feedsieve.operators.load import latest_per_key
from feedsieve.operators.references import reference_keys, small_enough
from feedsieve.rules import Rule, exists_in, row_rules
from feedsieve.schemas import rejected_schema

REJECTED_COLUMNS = tuple(f.name for f in rejected_schema())


def quarantine(
    trades: DataFrame,
    references: References | None,
    rules: Sequence[Rule],
    run_id: str | Column,
    rejected_at: dt.datetime | Column | None = None,
) -> DataFrame:
    """Failing rows in the ``rejected_trades`` layout; the input is left alone."""
    if rejected_at is None:
        rejected_at = F.current_timestamp()
    stamp = rejected_at if isinstance(rejected_at, Column) else F.lit(rejected_at)
    tag = run_id if isinstance(run_id, Column) else F.lit(run_id)
    # What the record itself says; columns of these names in a drifted input are not copied.
    own = {"reasons": F.col("reasons"), "run_id": tag, "rejected_at": stamp}
    rejected = failing_rows(trades, references, rules)
    return rejected.select(
        *[
            own[f.name].alias(f.name)
            if f.name in own
            else F.col(f.name)
            if f.name in trades.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in rejected_schema()
        ]
    )


def quarantine_upsert(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Quarantine after another pass: a re-rejected trade takes its new record.

    A trade that has been fully repaired keeps its old record and run. Rejected
    rows are few beside the trades, so both sides are grouped by trade instead
    of joined: that computes each of them once.
    """
    passes = existing.withColumn("_pass", F.lit(0)).unionByName(
        incoming.withColumn("_pass", F.lit(1))
    )
    latest = latest_per_key(passes, "trade_id", ["_pass"]).drop("_pass")
    return latest.unionByName(_latest_unkeyed(passes, ["_pass"]).drop("_pass"))


def current_rejected(records: DataFrame) -> DataFrame:
    """Latest record per trade from the records of all runs.

    A row without a trade_id stands for itself: its latest record stays.
    """
    order = ["rejected_at", "run_id"]
    return latest_per_key(records, "trade_id", order).unionByName(_latest_unkeyed(records, order))


def _latest_unkeyed(records: DataFrame, order: Sequence[str]) -> DataFrame:
    own = ("reasons", "run_id", "rejected_at")
    same = [c for c in records.columns if c not in own and c not in order]
    rest = [c for c in records.columns if c not in same and c not in order]
    return (
        records.where(F.col("trade_id").isNull())
        .groupBy(*same)
        .agg(F.max(F.struct(*order, *rest)).alias("_latest"))
        .select(*[F.col(c) if c in same else F.col(f"_latest.{c}").alias(c) for c in records.columns])
    )


def reason_counts(rejected: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per broken rule; a row broken twice counts for both."""
    return (
        rejected.select(*by, F.explode("reasons").alias("reason"))
        .groupBy(*by, "reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def rows_rejected(rejected: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows per run, or of one run."""
    if run_id is not None:
        rejected = rejected.where(F.col("run_id") == run_id)
    return rejected.groupBy("run_id").agg(F.count(F.lit(1)).alias("rows_rejected"))


def worst_reason(counts: DataFrame) -> DataFrame:
    """The most common reason, ties by name; "none" without any."""
    nothing = counts.sparkSession.range(1).select(
        F.lit("none").alias("reason"), F.lit(0).cast("long").alias("n")
    )
    return counts.select("reason", "n").unionByName(nothing).orderBy(F.desc("n"), "reason").limit(1)


def quarantine_result(
    rejected: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()
) -> DataFrame:
    """One row (per group): rows rejected and the name-sorted counts per reason.

    A single aggregation; the reasons are known from the rules, so nothing is
    exploded or collected.
    """
    names = sorted(r.name for r in row_rules(rules))
    counted = rejected.groupBy(*by).agg(
        F.expr("count(1) AS rows_rejected"),
        *[
            F.expr(f"count_if(array_contains(reasons, {literal(n)})) AS {quoted('n_' + n)}")
            for n in names
        ],
    )
    listed = ", ".join(f"struct({literal(n)} AS reason, {quoted('n_' + n)} AS n)" for n in names)
    counts = f"CAST(array({listed}) AS ARRAY<STRUCT<reason: STRING, n: BIGINT>>)"
    return counted.selectExpr(
        *map(quoted, by), "rows_rejected", f"filter({counts}, c -> c.n > 0) AS reason_counts"
    )


def orphan_trades(trades: DataFrame, instruments: DataFrame) -> DataFrame:
    """Trades whose instrument is not in the reference data."""
    known = exists_in("known_instrument", "instrument_id", "instrument", "instrument_id", "")
    return offenders(trades, instruments, known, ["trade_id", "instrument_id"])


def resolve_orphans(
    records: DataFrame,
    arrived: DataFrame,
    rule: str,
    run_id: str | Column,
    rejected_at: dt.datetime | Column,
    column: str = "instrument_id",
) -> DataFrame:
    """Records whose reference has arrived since, without that reason, and whether none is left.

    ``records`` are the current ones and ``arrived`` the reference rows that are new: only records that lack just
    these are touched, and the fact table is not read. The new references are measured before they are broadcast.
    A ``resolved`` record has no reasons: its trade may be released. The others are new records of the run.
    """
    stamp = rejected_at if isinstance(rejected_at, Column) else F.lit(rejected_at)
    tag = run_id if isinstance(run_id, Column) else F.lit(run_id)
    keys = reference_keys(arrived, column)
    if small_enough(arrived.select(column)):
        keys = F.broadcast(keys)
    orphans = records.where(F.array_contains("reasons", rule))
    left = orphans.join(keys, column, "left_semi").withColumn("reasons", F.array_remove("reasons", rule))
    return left.select(
        *[c for c in records.columns if c not in ("run_id", "rejected_at")],
        tag.alias("run_id"),
        stamp.alias("rejected_at"),
        (F.size("reasons") == 0).alias("resolved"),
    )


def orphan_keys(trades: DataFrame, instruments: DataFrame) -> DataFrame:
    """Unknown instruments and the trades naming each.

    Counted per key before the anti join, so a hot key meets the join as one row.
    """
    counted = (
        trades.where("instrument_id is not null")
        .groupBy("instrument_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.join(
        reference_keys(instruments, "instrument_id"), "instrument_id", "left_anti"
    )
