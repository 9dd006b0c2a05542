"""A quality run that reads only the partitions a load touched.

Counters of every other partition come from ``partition_counters``, where earlier loads left them; rows in duplicate
groups come from ``duplicate_changes``. The report is that of the whole table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedsieve.operators.labels import References
from feedsieve.operators.partitions import (
    counter_state,
    duplicate_change,
    emptied_state,
    fold_state,
    partition_counters,
)
from feedsieve.operators.report import report_rows, unique_row
from feedsieve.plans.quality_run import ALWAYS, RunOutcome, run_quality
from feedsieve.rules import UNIQUE, Rule, readable, trade_rules
from feedsieve.sources.key_index import KeyIndex, duplicates_after
from feedsieve.sources.tables import QualityTables
from feedsieve.sources.trades import DAY, LoadOutcome, TradeTable
from feedsieve.sources.versions import partition_text, partition_value


def record_partitions(
    tables: QualityTables,
    rows: DataFrame,
    touched: DataFrame,
    references: References | None,
    rules: Sequence[Rule],
    partition: str,
    load: int,
) -> None:
    """Count the touched partitions (``place`` as text) anew and store that with the load's number.

    ``rows`` are those of the touched partitions. One of them may have none left.
    """
    counted = partition_counters(rows, references, rules, partition)
    state = counter_state(counted, rules, partition_text(partition), load)
    empty = touched.select("place").distinct().join(state.select("place"), "place", "left_anti")
    tables.add_counters(state.unionByName(emptied_state(empty, load)))


def record_keys(tables: QualityTables, index: KeyIndex, arrived: DataFrame, loads: DataFrame, place: Column, load: int) -> None:
    """For a table that loads only add to: store what a load changed in duplicates, and index its keys.

    ``loads`` are the finished ones before it.
    """
    tables.add_duplicate_change(duplicate_change(duplicates_after(index, arrived, loads), load))
    index.add(arrived, place, load)


def scoped_report(
    tables: QualityTables, rules: Sequence[Rule], columns: Sequence[str], as_of: str | dt.date | Column | None = None
) -> DataFrame:
    """``rule_report`` of the whole table, from stored counters alone."""
    counted = fold_state(tables.counters(), rules)
    report = report_rows(counted, rules, columns, as_of)
    for position, rule in enumerate(rules):
        if rule.kind == UNIQUE and readable(rule, columns):
            summary = counted.select("rows_checked", tables.duplicate_rows().scalar().alias("duplicate_rows"))
            report = report.unionByName(unique_row(summary, position, rule))
    return report


def run_scoped(
    table: TradeTable,
    loaded: LoadOutcome,
    references: References | None,
    tables: QualityTables,
    rules: Sequence[Rule] | None = None,
    run_id: str | None = None,
    as_of: str | dt.date | None = None,
    now: dt.datetime | None = None,
    quarantine_when: str = ALWAYS,
) -> RunOutcome:
    """The run after a load into the trade table: counters, report, quarantine of the days it touched.

    The first run on a table that was loaded before has to be given all its days as touched. Trades are
    unique in a table loaded by upsert, so no load changes the number of duplicates.
    """
    rules = trade_rules() if rules is None else list(rules)
    tables.ensure()
    values = [partition_value(r[DAY]) for r in loaded.days.collect()]  # a row per touched day
    manifest = table.store.manifest(loaded.version)
    rows = table.store.rows_of(manifest, values)
    places = table.spark.createDataFrame([(v,) for v in values], "place string")
    columns = table.layout.fieldNames()
    record_partitions(tables, rows.select(*columns, DAY), places, references, rules, DAY, loaded.version)
    report = scoped_report(tables, rules, columns, as_of)
    return run_quality(
        rows.select(*columns), references, tables, rules, run_id, as_of, now, quarantine_when, report
    )
