import re

from pyspark.sql import functions as F

from feedsieve.operators import partitions as P
from feedsieve.operators import pnl, report
from feedsieve.operators.load import typed_feed
from feedsieve.rules import trade_rules

from .conftest import AS_OF, as_dict, row

RULES = trade_rules()
UNSCOPED = [r for r in RULES if r.kind != "unique"]


def dated(feed, *rows):
    return typed_feed(feed(*rows)).withColumn("trade_date", pnl.trade_date())


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_merged_counters_equal_the_whole_table(feed, instruments):
    table = dated(
        feed,
        row("A", executed_at="2024-04-01"),
        row("B", executed_at="2024-04-02", price=""),
        row("C", executed_at="2024-04-02", instrument_id=9),
        row("D", executed_at="", side="X"),
    )
    parts = P.partition_counters(table, instruments, RULES, "trade_date")
    assert parts.count() == 3
    merged = report.merge_counters(parts)
    whole = report.counters(table.drop("trade_date"), instruments, RULES)
    assert rows_of(merged.select(*whole.columns)) == rows_of(whole)


def test_rechecking_touched_days_updates_the_report(feed, instruments):
    before = [row("A", executed_at="2024-04-01"), row("B", executed_at="2024-04-02")]
    later = [row("C", executed_at="2024-04-02", price=""), row("D", executed_at="", side="")]
    stored = P.partition_counters(dated(feed, *before), instruments, RULES, "trade_date")
    table = dated(feed, *before, *later)
    touched = dated(feed, *later).select("trade_date")
    scoped = P.touched_partitions(table, touched, "trade_date")
    assert {r.trade_id for r in scoped.collect()} == {"B", "C", "D"}
    fresh = P.partition_counters(scoped, instruments, RULES, "trade_date")
    merged = report.merge_counters(P.replace_partitions(stored, fresh, "trade_date"))
    columns = [c for c in table.columns if c != "trade_date"]
    got = report.report_rows(merged, UNSCOPED, columns, AS_OF)
    expected = report.rule_report(table.drop("trade_date"), instruments, UNSCOPED, AS_OF)
    assert rows_of(got) == rows_of(expected)


def test_uniqueness_compares_touched_keys_with_the_whole_table(feed):
    table = dated(
        feed,
        row("A", executed_at="2024-04-01"),
        row("A", executed_at="2024-04-02"),
        row("B", executed_at="2024-04-01"),
        row("B", executed_at="2024-04-01"),
        row("C", executed_at="2024-04-02"),
    )
    touched = table.where(F.col("trade_date") == "2024-04-02")
    assert as_dict(P.touched_duplicates(table, touched), "trade_id", "n") == {"A": 2}


def test_touched_partitions_prune_folders(spark, feed, tmp_path):
    path = str(tmp_path / "trades")
    dated(
        feed,
        row("A", executed_at="2024-04-01"),
        row("B", executed_at="2024-04-02"),
        row("C", executed_at="2024-04-03"),
    ).write.partitionBy("trade_date").parquet(path)
    table = spark.read.parquet(path)
    touched = table.where("trade_id = 'B'").select("trade_date")
    scoped = P.touched_partitions(table, touched, "trade_date")
    text = scoped._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", text)
    assert [r.trade_id for r in P.touched_partitions(table, touched, "trade_date").collect()] == [
        "B"
    ]
