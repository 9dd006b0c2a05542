"""One quality run end to end: report, verdict, quarantine, history.

Only the report (one row per rule) and the counts of the run reach the driver.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedsieve.functions.text import outcome_line, quarantine_line
from feedsieve.operators.labels import References, any_failure, rule_flags
from feedsieve.operators.partitions import touched_partitions
from feedsieve.operators.pnl import daily_pnl, trade_date
from feedsieve.operators.quarantine import quarantine, quarantine_result
from feedsieve.operators.report import rule_report, verdict
from feedsieve.rules import Rule, trade_rules
from feedsieve.sources.tables import QualityTables, write_by_day

ALWAYS = "always"
ON_FAILURE = "on_failure"
NEVER = "never"


def refresh_daily(
    trades: DataFrame,
    references: References | None,
    path: str,
    rules: Sequence[Rule] | None = None,
    days: DataFrame | None = None,
) -> int:
    """Recompute the daily aggregate of some days from their valid trades.

    ``days`` are those a load touched, old and new ones (``pnl.touched_days``); without it,
    all days in ``trades``. The table is partitioned by day and only these are
    replaced. A day and instrument left without a valid trade is stored with none, or its
    former row would stay. Valid trades without a day are in no partition: their number is returned.
    """
    rules = trade_rules() if rules is None else rules
    if days is not None:
        trades = touched_partitions(
            trades.withColumn("trade_date", trade_date()), days, "trade_date"
        ).drop("trade_date")
    marked, flags = rule_flags(trades, references, rules)
    valid = f"NOT {any_failure(flags)}"
    daily = daily_pnl(marked, valid).where(F.col("trade_date").isNotNull())
    if days is not None:
        empty = days.where("trade_date IS NOT NULL").select("trade_date").distinct()
        empty = empty.join(daily.select("trade_date").distinct(), "trade_date", "left_anti")
        daily = daily.unionByName(empty.withColumn("trades", F.lit(0).cast("long")), True)
    write_by_day(daily, path)
    undated = marked.where(valid).where(trade_date().isNull())
    return undated.count()


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """The stored daily aggregate."""
    return spark.read.parquet(path).where(F.col("trades") > 0)


@dataclass(frozen=True)
class RunOutcome:
    """What a run found; ``success`` decides what comes next."""

    run_id: str
    success: bool
    rows_checked: int
    rules_total: int
    failed_rules: list[str]
    rows_rejected: int
    reason_counts: dict[str, int] = field(default_factory=dict)
    summary: str = ""
    quarantine_summary: str = ""

    @property
    def rules_failed(self) -> int:
        return len(self.failed_rules)


def run_quality(
    trades: DataFrame,
    references: References | None,
    tables: QualityTables,
    rules: Sequence[Rule] | None = None,
    run_id: str | None = None,
    as_of: str | dt.date | None = None,
    now: dt.datetime | None = None,
    quarantine_when: str = ALWAYS,
    report: DataFrame | None = None,
) -> RunOutcome:
    """Check ``trades``, quarantine what fails and record the run.

    With a ``report`` made elsewhere (``scoped_run``) ``trades`` are only those to be quarantined.

    Bad data is an outcome, not an error. ``quarantine_when`` is ``always``,
    ``on_failure`` (only after a failed verdict) or ``never``. The run row is
    written last, so an interrupted run stays ``running`` and can be repeated
    under the same ``run_id``.

    The table is read up to three times (counters, key column, failing rows),
    with only the columns each needs; pass a stored table rather than a plan
    that is costly to repeat.
    """
    if quarantine_when not in (ALWAYS, ON_FAILURE, NEVER):
        raise ValueError(f"unknown quarantine_when: {quarantine_when}")
    rules = trade_rules() if rules is None else list(rules)
    run_id = run_id or str(uuid.uuid4())
    stamp = now or dt.datetime.now(dt.timezone.utc)
    spark = trades.sparkSession

    tables.ensure()
    tables.start_run(run_id, stamp)

    plan = rule_report(trades, references, rules, as_of) if report is None else report
    found = plan.collect()
    report = spark.createDataFrame(found, plan.schema)
    result = verdict(report).withColumn("summary", outcome_line()).first()

    wanted = quarantine_when == ALWAYS or (quarantine_when == ON_FAILURE and not result["success"])
    # The report counted the very predicates that label rows: all zero means no rows to copy.
    broken = any(r["scope"] == "row" and r["failing_rows"] for r in found)
    if wanted and broken:
        tables.write_rejected(quarantine(trades, references, rules, run_id, F.lit(stamp)))
    elif wanted:
        tables.clear_rejected(run_id)  # a repeat replaces what the run rejected before
    line = quarantine_line(F.col("rows_rejected"), F.col("reason_counts"))
    counted = quarantine_result(tables.rejected(run_id), rules)
    row = counted.withColumn("summary", line).first()
    tables.finish_run(run_id, report, rules, now or dt.datetime.now(dt.timezone.utc))

    return RunOutcome(
        run_id=run_id,
        success=result["success"],
        rows_checked=result["rows_checked"],
        rules_total=result["rules_total"],
        failed_rules=list(result["failed_rules"]),
        rows_rejected=row["rows_rejected"],
        reason_counts={c["reason"]: c["n"] for c in row["reason_counts"]},
        summary=result["summary"],
        quarantine_summary=row["summary"],
    )
