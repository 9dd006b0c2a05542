"""Rule-level report, verdict and the table-level checks.

Row rules, freshness and the row count come out of one aggregation without a
shuffle of rows. Uniqueness needs its own: it reads the key column alone and
combines equal keys on the map side, so one key in a third of the rows is one
counter per task.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedsieve.functions.predicates import literal, quoted
from feedsieve.operators.labels import References, rule_flags
from feedsieve.rules import (
    COLUMNS,
    FRESH,
    NEVER_TRADED_DAYS,
    UNIQUE,
    Rule,
    readable,
    schema_drift,
)

REPORT_COLUMNS = (
    "position",
    "rule",
    "category",
    "scope",
    "description",
    "success",
    "failing_rows",
    "observed",
    "rows_checked",
)


def as_of_date(as_of: str | dt.date | Column | None) -> Column:
    """The day ages are measured against; today unless given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)[:10]).cast("date")


def age_days_sql(newest: str, day: str) -> str:
    """Whole days from ``newest`` to ``day``; a fixed large age when there is none."""
    return f"coalesce(date_diff({day}, CAST({newest} AS DATE)), {NEVER_TRADED_DAYS})"


def feed_freshness(
    df: DataFrame,
    rule: Rule,
    as_of: str | dt.date | Column | None = None,
) -> DataFrame:
    """One row: newest execution time, its age and whether the rule holds."""
    newest = df.agg(F.max(rule.columns[0]).alias("newest"))
    age = age_days_sql("newest", "_as_of")
    # Future dates and ages above the limit both fail.
    return newest.withColumn("_as_of", as_of_date(as_of)).selectExpr(
        "newest",
        f"{age} AS days_since_latest",
        f"{age} BETWEEN 0 AND {rule.max_age_days} AS success",
    )


def duplicate_keys(df: DataFrame, column: str = "trade_id") -> DataFrame:
    """Keys held by more than one row; null keys are not compared."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def duplicate_summary(
    df: DataFrame, column: str = "trade_id", by: Sequence[str] = ()
) -> DataFrame:
    """One row (per group): rows in duplicate groups, such groups, rows without a key, all rows."""
    counted = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))
    key = quoted(column)
    aggregates = (
        f"coalesce(sum(IF({key} IS NOT NULL AND n > 1, n, 0L)), 0L) AS duplicate_rows",
        f"count_if({key} IS NOT NULL AND n > 1) AS duplicate_keys",
        f"coalesce(sum(IF({key} IS NULL, n, 0L)), 0L) AS null_keys",
        "coalesce(sum(n), 0L) AS rows_checked",
    )
    return counted.groupBy(*by).agg(*map(F.expr, aggregates))


def row_count_check(df: DataFrame, expected: int = 0) -> DataFrame:
    """Whether any derived DataFrame or view has exactly ``expected`` rows."""
    return df.agg(F.count(F.lit(1)).alias("observed")).select(
        "observed",
        F.lit(expected).cast("long").alias("expected"),
        (F.col("observed") == expected).alias("success"),
    )


def drift_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per expected or actual column: its status and how many rows fill it.

    The comparison itself is metadata; the counts say how far an added column
    has already spread. One aggregation over the table.
    """
    actual = df.columns
    drift = schema_drift(actual, expected)
    status = {c: "expected" for c in expected}
    status.update({c: "missing" for c in drift["missing"]})
    status.update({c: "added" for c in drift["added"]})
    zero = F.lit(0).cast("long")
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.count(F.col(c)).alias(f"filled_{c}") for c in actual],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(s).alias("status"),
            (F.col(f"filled_{c}") if c in actual else zero).alias("rows_filled"),
            F.col("rows_checked").alias("rows_checked"),
        )
        for c, s in status.items()
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def counters(
    df: DataFrame,
    references: References | None,
    rules: Sequence[Rule],
    by: Sequence[str] = (),
) -> DataFrame:
    """Mergeable counters, one row per group: add counts, take the larger newest.

    ``n_<rule>`` per readable row rule, ``newest_<rule>`` per readable freshness
    rule, and ``rows_checked``. Uniqueness is not mergeable and not included.
    """
    marked, flags = rule_flags(df, references, rules)
    aggregates = ["count(1) AS rows_checked"]
    aggregates += [f"count_if({flag}) AS {quoted('n_' + name)}" for name, flag in flags.items()]
    aggregates += [
        f"max({quoted(r.columns[0])}) AS {quoted('newest_' + r.name)}"
        for r in rules
        if r.kind == FRESH and readable(r, df.columns)
    ]
    return marked.groupBy(*by).agg(*map(F.expr, aggregates))


def merge_counters(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counters of partitions combined into those of their union."""
    zero = F.lit(0).cast("long")
    aggregates = []
    for name in parts.columns:
        if name.startswith("newest_"):
            aggregates.append(F.max(name).alias(name))
        elif name == "rows_checked" or name.startswith("n_"):
            aggregates.append(F.coalesce(F.sum(name), zero).alias(name))
    return parts.groupBy(*by).agg(*aggregates)


def report_rows(
    counted: DataFrame,
    rules: Sequence[Rule],
    table_columns: Sequence[str],
    as_of: str | dt.date | Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Counters turned into one row per rule (and group), uniqueness left out."""
    entries = []
    day = "_as_of"
    for position, rule in enumerate(rules):
        if not readable(rule, table_columns):
            entries.append(_entry(position, rule, "false", "CAST(NULL AS BIGINT)", None))
        elif rule.kind == UNIQUE:
            continue
        elif rule.kind == COLUMNS:
            drift = schema_drift(table_columns, rule.expected_columns)
            changed = len(drift["added"]) + len(drift["missing"])
            listed = literal(json.dumps(list(table_columns)))
            entries.append(
                _entry(position, rule, str(changed == 0).lower(), f"{changed}L", listed)
            )
        elif rule.kind == FRESH:
            age = age_days_sql(quoted(f"newest_{rule.name}"), day)
            fresh = f"{age} BETWEEN 0 AND {rule.max_age_days}"
            failing = f"IF({fresh}, 0L, 1L)"
            entries.append(_entry(position, rule, fresh, failing, f"CAST({failing} AS STRING)"))
        else:
            failing = quoted(f"n_{rule.name}")
            entries.append(
                _entry(position, rule, f"{failing} = 0", failing, f"CAST({failing} AS STRING)")
            )
    return _unpivoted(counted.withColumn(day, as_of_date(as_of)), entries, by)


def unique_rows(
    df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()
) -> list[DataFrame]:
    """Report rows of the uniqueness rules, one aggregation each."""
    return [
        unique_row(duplicate_summary(df, rule.columns[0], by), position, rule, by)
        for position, rule in enumerate(rules)
        if rule.kind == UNIQUE and readable(rule, df.columns)
    ]


def unique_row(summary: DataFrame, position: int, rule: Rule, by: Sequence[str] = ()) -> DataFrame:
    """Report row of a uniqueness rule from ``duplicate_rows`` and ``rows_checked``."""
    failing = "duplicate_rows"
    entry = _entry(position, rule, f"{failing} = 0", failing, f"CAST({failing} AS STRING)")
    return _unpivoted(summary, [entry], by)


def rule_report(
    df: DataFrame,
    references: References | None,
    rules: Sequence[Rule],
    as_of: str | dt.date | Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per rule over the whole table, or over each group of ``by``.

    The columns of ``by`` are tags of the run, not part of the checked table;
    ``as_of`` may be an expression of them.
    """
    checked = [c for c in df.columns if c not in by]
    parts = unique_rows(df, rules, by)
    if any(r.kind != UNIQUE or not readable(r, checked) for r in rules):
        counted = counters(df, references, rules, by)
        parts.insert(0, report_rows(counted, rules, checked, as_of, by))
    if not parts:
        raise ValueError("no rules")
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def verdict(report: DataFrame, by: Sequence[str] = (), *more: Column) -> DataFrame:
    """One row (per run): success, counts and the sorted names of failed rules.

    ``more`` are further aggregates of the report rows.
    """
    return report.groupBy(*by).agg(
        F.bool_and("success").alias("success"),
        F.max("rows_checked").alias("rows_checked"),
        F.count(F.lit(1)).cast("int").alias("rules_total"),
        F.count_if(~F.col("success")).cast("int").alias("rules_failed"),
        F.array_sort(F.collect_set(F.when(~F.col("success"), F.col("rule")))).alias(
            "failed_rules"
        ),
        *more,
    )


def category_report(report: DataFrame) -> DataFrame:
    """Report rolled up by rule category."""
    return report.groupBy("category").agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(~F.col("success")).alias("rules_failed"),
        F.coalesce(F.sum("failing_rows"), F.lit(0).cast("long")).alias("failing_rows"),
        F.bool_and("success").alias("success"),
    )


def rule_agreement(report: DataFrame, counts: DataFrame) -> DataFrame:
    """Reported failures beside quarantined ones, per row-level rule."""
    reported = report.where("scope = 'row'").select("rule", F.col("failing_rows").alias("reported"))
    quarantined = counts.select(F.col("reason").alias("rule"), F.col("n").alias("quarantined"))
    zero = F.lit(0).cast("long")
    return (
        reported.join(quarantined, "rule", "full_outer")
        .select(
            "rule",
            F.coalesce("reported", zero).alias("reported"),
            F.coalesce("quarantined", zero).alias("quarantined"),
        )
        .withColumn("agree", F.col("reported") == F.col("quarantined"))
    )


def _entry(position: int, rule: Rule, success: str, failing: str, observed: str | None) -> str:
    """SQL of one report row, in the order of ``REPORT_COLUMNS``."""
    texts = [rule.name, rule.category, rule.scope, rule.description]
    return ", ".join(
        [
            str(position),
            *map(literal, texts),
            success,
            failing,
            observed or "CAST(NULL AS STRING)",
            "rows_checked",
        ]
    )


def _unpivoted(counted: DataFrame, entries: Sequence[str], by: Sequence[str]) -> DataFrame:
    names = ", ".join(REPORT_COLUMNS)
    rows = f"stack({len(entries)}, {', '.join(entries)}) AS ({names})"
    return counted.selectExpr(*map(quoted, by), rows)
