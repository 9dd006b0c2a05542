"""Run history: state rows appended per start and finish, folded to one row per run.

The history holds one row per run, so it stays small however large the checked
table is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedsieve.functions.text import history_line
from feedsieve.operators.report import verdict
from feedsieve.schemas import run_schema

RUN_COLUMNS = tuple(f.name for f in run_schema())


def start_states(starts: DataFrame) -> DataFrame:
    """``(run_id, started_at)`` rows as ``running`` states."""
    stamp = starts.schema["started_at"].dataType
    return starts.select(
        "run_id",
        "started_at",
        F.lit(None).cast(stamp).alias("finished_at"),
        F.lit("running").alias("status"),
        F.lit(0).cast("long").alias("rows_checked"),
        F.lit(0).cast("long").alias("rows_rejected"),
        F.lit(0).alias("rules_total"),
        F.lit(0).alias("rules_failed"),
        F.lit("{}").alias("details"),
    )


def run_results(report: DataFrame, results: DataFrame) -> DataFrame:
    """Verdict, rejected rows and JSON details of each run, ready to be closed.

    ``report`` has a ``run_id`` and one row per rule, so a run collects as many
    entries as there are rules. ``results`` may lack a run: nothing was
    quarantined for it.
    """
    outcome = F.struct("success", "category", F.try_parse_json("observed").alias("observed"))
    judged = verdict(
        report,
        ["run_id"],
        F.map_from_entries(F.collect_list(F.struct("rule", outcome))).alias("rules"),
    )
    empty = F.create_map().cast("map<string,bigint>")
    reasons = F.coalesce(F.map_from_entries("reason_counts"), empty)
    document = F.to_json(
        F.struct("rules", reasons.alias("reason_counts")), {"ignoreNullFields": "false"}
    )
    return (
        judged.join(results, "run_id", "left")
        .withColumn("details", document)
        .withColumn("rows_rejected", F.coalesce("rows_rejected", F.lit(0).cast("long")))
        .drop("rules")
    )


def finish_states(results: DataFrame, finished_at: Column) -> DataFrame:
    """``run_results`` rows as closing states."""
    finished = results.withColumn("finished_at", finished_at)
    return finished.select(
        "run_id",
        F.lit(None).cast(finished.schema["finished_at"].dataType).alias("started_at"),
        "finished_at",
        F.when(F.col("success"), F.lit("passed")).otherwise(F.lit("failed")).alias("status"),
        "rows_checked",
        "rows_rejected",
        "rules_total",
        "rules_failed",
        "details",
    )


def fold_runs(states: DataFrame) -> DataFrame:
    """Current row of each run.

    The latest finish wins over ``running``; the first start is kept; a run that
    was never started began when it finished. Starting it afterwards changes
    nothing. Of finishes at the same time a failed one wins, then the one that
    rejected more: a repeat must not hide what was found.
    """
    result = [c for c in RUN_COLUMNS if c not in ("run_id", "started_at")]
    return (
        states.groupBy("run_id")
        .agg(
            F.min(F.coalesce("started_at", "finished_at")).alias("started_at"),
            # Nulls order first, so any finished state beats a running one.
            F.max(
                F.struct(
                    "finished_at",
                    (F.col("status") == "failed").alias("_worse"),
                    "rows_rejected",
                    *[c for c in result if c not in ("finished_at", "rows_rejected")],
                )
            ).alias("r"),
        )
        .select("run_id", "started_at", *[F.col(f"r.{c}").alias(c) for c in result])
    )


def start_run(runs: DataFrame, starts: DataFrame) -> DataFrame:
    """Runs with new ones opened; one that is known already is left as it is."""
    known = runs.select(F.lit(0).alias("_new"), *RUN_COLUMNS)
    opened = start_states(starts).select(F.lit(1).alias("_new"), *RUN_COLUMNS)
    row = F.min(F.struct("_new", *RUN_COLUMNS)).alias("_row")
    return (
        known.unionByName(opened)
        .where(F.col("run_id").isNotNull())
        .groupBy("run_id")
        .agg(row)
        .select("run_id", *[F.col(f"_row.{c}").alias(c) for c in RUN_COLUMNS[1:]])
    )


def finish_run(runs: DataFrame, finished: DataFrame) -> DataFrame:
    """Runs with ``finish_states`` rows applied."""
    return fold_runs(runs.select(*RUN_COLUMNS).unionByName(finished))


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    """Most recent runs, newest first."""
    return (
        runs.orderBy(F.desc("started_at"), F.desc("run_id"))
        .limit(limit)
        .select("run_id", "status", "rows_checked", "rows_rejected", "rules_failed", "started_at")
    )


def history_lines(runs: DataFrame, limit: int = 10) -> DataFrame:
    return recent_runs(runs, limit).select(history_line().alias("line"))


def rejection_trend(
    runs: DataFrame, columns: Sequence[str] = ("run_id", "started_at")
) -> DataFrame:
    """Rejection rate of each finished run and its change from the run before.

    The window orders the whole history in one task: a row per run, at most.
    """
    before = Window.orderBy("started_at", "run_id")
    rate = F.when(
        F.col("rows_checked") > 0,
        F.col("rows_rejected").cast("double") / F.col("rows_checked").cast("double"),
    )
    return (
        runs.where("status <> 'running'")
        .select(*columns, "rows_checked", "rows_rejected", rate.alias("rate"))
        .withColumn("change", F.col("rate") - F.lag("rate").over(before))
    )


def rejection_alarm(
    runs: DataFrame, baseline: int = 5, slack_ppm: int = 0, limit_ppm: int = 10_000
) -> DataFrame:
    """Whether rejection is getting worse: a one-sided CUSUM over the finished runs.

    Rates are whole rejected rows per million, so sums are exact. Each run adds what its rate exceeds the expected one by,
    less ``slack_ppm``; the sum never falls below zero, and above ``limit_ppm`` it is an alarm. Expected is the mean
    of the first ``baseline`` runs. A lasting small rise so shows as well as one bad run, which the difference from the
    run before does not tell apart from noise.

    The sum with its floor at zero is the running sum less its own lowest value so far, so two windows do.
    They order the history in one task: a row per run, at most.
    """
    order = Window.orderBy("started_at", "run_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = Window.orderBy("started_at", "run_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    checked = runs.where("status <> 'running' AND rows_checked > 0").select(
        "run_id",
        "started_at",
        F.expr("rows_rejected * 1000000 DIV rows_checked").alias("ppm"),
        F.row_number().over(order).alias("_n"),
    )
    early = F.when(F.col("_n") <= baseline, F.col("ppm"))
    expected = F.sum(early).over(first), F.count(early).over(first)
    drift = checked.withColumn("_sum", expected[0]).withColumn("_runs", expected[1])
    drift = drift.withColumn("expected_ppm", F.expr("_sum DIV _runs"))
    drift = drift.withColumn("_level", F.sum(F.col("ppm") - F.col("expected_ppm") - slack_ppm).over(so_far))
    lowest = F.least(F.lit(0).cast("long"), F.min("_level").over(so_far))
    return drift.withColumn("cusum_ppm", F.col("_level") - lowest).select(
        "run_id", "started_at", "ppm", "expected_ppm", "cusum_ppm", (F.col("cusum_ppm") > limit_ppm).alias("alarm")
    )
