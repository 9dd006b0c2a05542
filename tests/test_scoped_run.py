"""Runs that read only what a load touched."""

import os

import pytest
from pyspark.sql import functions as F

from feedsieve.operators import partitions, report
from feedsieve.plans.scoped_run import record_keys, record_partitions, run_scoped, scoped_report
from feedsieve.rules import in_set, trade_rules
from feedsieve.schemas import TRADE_COLUMNS
from feedsieve.sources.key_index import KeyIndex
from feedsieve.sources.tables import QualityTables
from feedsieve.sources.trades import DAY, TradeTable

from .conftest import AS_OF, NOW, row

RULES = trade_rules()


@pytest.fixture()
def table(spark, tmp_path):
    return TradeTable(spark, str(tmp_path / "lake"))


@pytest.fixture()
def tables(spark, tmp_path):
    return QualityTables(spark, str(tmp_path / "quality"))


def rows_of(df):
    return sorted(map(str, df.collect()))


def run(table, loaded, instruments, tables, run_id, **options):
    return run_scoped(table, loaded, instruments, tables, RULES, run_id, AS_OF, NOW, **options)


def test_report_and_quarantine_equal_full_ones_without_reading_other_days(table, tables, feed, instruments):
    first = table.load(
        feed(
            row("A", executed_at="2024-04-01"),
            row("B", executed_at="2024-04-02", price=""),
            row("C", executed_at="2024-04-03", instrument_id=9),
            row("D", executed_at="", side="X"),
        ),
        "one",
    )
    found = run(table, first, instruments, tables, "run-1")
    assert (found.rows_checked, found.rows_rejected) == (4, 3)

    # Day one is never opened again.
    folder = f"{table.store.data}/v=1/{DAY}=2024-04-01"
    kept = {}
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "rb") as file:
                kept[name] = file.read()
            with open(f"{folder}/{name}", "wb") as file:
                file.write(b"no parquet")
    second = table.load(
        feed(
            row("B", executed_at="2024-04-04"),  # mended, and day two is left empty
            row("E", executed_at="2024-04-03", quantity=-1),
        ),
        "two",
    )
    found = run(table, second, instruments, tables, "run-2")
    got = scoped_report(tables, RULES, TRADE_COLUMNS, AS_OF)
    for name, content in kept.items():
        with open(f"{folder}/{name}", "wb") as file:
            file.write(content)
    for name in os.listdir(folder):  # checksums of what was there
        if name.endswith(".crc"):
            os.utime(f"{folder}/{name}")
    assert rows_of(got) == rows_of(report.rule_report(table.rows(), instruments, RULES, AS_OF))
    assert found.rows_checked == 5
    assert {r.trade_id for r in tables.rejected("run-2").collect()} == {"C", "E"}


def test_a_repeated_run_changes_nothing(table, tables, feed, instruments):
    loaded = table.load(feed(row("A"), row("B", price="")), "one")
    once = run(table, loaded, instruments, tables, "run-1")
    before = rows_of(scoped_report(tables, RULES, TRADE_COLUMNS, AS_OF))
    assert run(table, loaded, instruments, tables, "run-1") == once
    assert rows_of(scoped_report(tables, RULES, TRADE_COLUMNS, AS_OF)) == before


def test_a_rule_never_counted_is_not_taken_for_passed(table, tables, feed, instruments):
    loaded = table.load(feed(row("A"), row("B")), "one")
    run(table, loaded, instruments, tables, "run-1")
    new = in_set("side_is_buy", "side", ["BUY"], "Only buys.")
    got = scoped_report(tables, [new], TRADE_COLUMNS, AS_OF).first()
    assert got.rule == "side_is_buy" and got.success is None and got.failing_rows is None


def test_duplicates_of_a_table_that_only_grows(spark, tables, feed, instruments, tmp_path):
    from feedsieve.operators.load import typed_feed
    from feedsieve.operators.pnl import trade_date
    from feedsieve.sources.versions import partition_text

    tables.ensure()
    index = KeyIndex(spark, str(tmp_path / "keys"), expected_keys=1_000)
    batches = [
        feed(row("A"), row("A"), row("B"), row(""), row("")),
        feed(row("A"), row("B"), row("C", executed_at="2024-04-09", price="")),
        feed(row("C"), row("D"), row("D"), row("D")),
    ]
    whole = None
    for load, batch in enumerate(batches, 1):
        rows = typed_feed(batch).withColumn(DAY, trade_date())
        whole = rows if whole is None else whole.unionByName(rows)
        touched = partitions.touched_partitions(whole, rows, DAY)
        places = rows.select(partition_text(DAY).alias("place"))
        finished = spark.createDataFrame([(n,) for n in range(1, load)], "load long")
        for _ in range(2):  # storing counters twice counts once
            record_partitions(tables, touched, places, instruments, RULES, DAY, load)
        record_keys(tables, index, rows, finished, F.lit("x"), load)
        got = scoped_report(tables, RULES, TRADE_COLUMNS, AS_OF)
        assert rows_of(got) == rows_of(report.rule_report(whole.drop(DAY), instruments, RULES, AS_OF))


def test_an_empty_first_load(table, tables, feed, instruments):
    loaded = table.load(feed(row("A")).limit(0), "none")
    found = run(table, loaded, instruments, tables, "run-1")
    assert (found.rows_checked, found.rows_rejected) == (0, 0)
