"""The stored trade table."""

import pytest
from pyspark.sql import functions as F

from feedsieve.operators.load import load_trades, source_watermarks
from feedsieve.operators.report import feed_freshness
from feedsieve.plans.quality_run import read_daily, refresh_daily
from feedsieve.rules import trade_rules
from feedsieve.schemas import trade_schema
from feedsieve.sources.trades import DAY, TradeTable

from .conftest import row


@pytest.fixture()
def table(spark, tmp_path):
    return TradeTable(spark, str(tmp_path / "lake"))


def text(rows):
    return sorted(map(str, rows.collect()))


def test_loads_equal_the_plain_upsert_and_count_every_row(spark, table, feed):
    first = feed(
        row("A", executed_at="2024-04-01"),
        row("A", executed_at="2024-04-01", price="11"),
        row("B", executed_at="2024-04-01"),
        row("C", executed_at="2024-04-02"),
        row("D", executed_at=""),
        row(None, executed_at="2024-04-02"),
    )
    second = feed(
        row("A", executed_at="2024-04-04"),
        row("B", executed_at="2024-04-03"),
        row("D", executed_at="2024-04-03", side="SELL"),
        row("E", executed_at="2024-04-02"),
        row("", executed_at="2024-04-02", side="SELL"),
        row("", executed_at=""),
    )
    found = table.load(first, "one")
    assert (found.rows_in, found.rows_upserted, found.rows_superseded) == (6, 4, 1)
    assert (found.rows_late, found.rows_unkeyed) == (0, 1)
    empty = spark.createDataFrame([], trade_schema())
    once = load_trades(empty, first)
    assert text(table.rows()) == text(once)

    found = table.load(second, "two")
    assert (found.rows_in, found.rows_upserted, found.rows_unkeyed) == (6, 4, 2)
    # The days that were left count as touched: April 1st and the undated ones.
    touched = {str(r[DAY]) for r in found.days.collect()}
    assert touched == {"2024-04-01", "2024-04-02", "2024-04-03", "2024-04-04", "None"}
    twice = text(load_trades(once, second))
    assert text(table.rows()) == twice
    table.load(second, "two")
    assert text(table.rows()) == twice


def test_rows_without_an_id_belong_to_their_batch(table, feed):
    """Equal lines of two batches are two trades; a batch loaded again brings what it brought before."""
    batch = feed(row("A"), row(""), row(""))
    for name, stored in (("one", 2), ("two", 4), ("one", 4), ("two", 4)):
        assert table.load(batch, name).rows_unkeyed == 2
        assert table.rows().where("trade_id IS NULL").count() == stored
    # Mended, batch one moves one of its rows to another day and no longer has the other.
    table.load(feed(row("", executed_at="2024-04-09")), "one")
    days = sorted(str(r.executed_at)[:10] for r in table.rows().where("trade_id IS NULL").collect())
    assert days == ["2024-04-09", "2024-05-01", "2024-05-01"]
    table.load(feed(row("A")), "two")
    assert table.rows().where("trade_id IS NULL").count() == 1


def test_a_feed_lacking_a_column_is_loaded_with_nulls(table, feed):
    table.load(feed(row("A"), row("B")), "one")
    found = table.load(feed(row("B", side="SELL"), row("C")).drop("price"), "two")
    assert (found.rows_in, found.rows_upserted) == (2, 2)
    prices = {r.trade_id: r.price for r in table.rows().collect()}
    assert prices["A"] is not None and prices["B"] is None and prices["C"] is None
    unnamed = table.load(feed(row("D")).drop("trade_id"), "three")
    assert unnamed.rows_unkeyed == 1 and table.rows().where("trade_id IS NULL").count() == 1


def test_days_left_empty_are_gone(table, feed):
    table.load(feed(row("A", executed_at="2024-04-01"), row("B", executed_at="")), "one")
    table.load(
        feed(row("A", executed_at="2024-04-02"), row("B", executed_at="2024-04-02")), "two"
    )
    assert [str(r[DAY]) for r in table.store.rows().select(DAY).collect()] == ["2024-04-02"] * 2


def test_an_empty_feed_changes_nothing(table, feed):
    table.load(feed(row("A")), "one")
    before = text(table.rows())
    found = table.load(feed(row("A")).limit(0), "none")
    assert (found.rows_in, found.rows_upserted, found.days.count()) == (0, 0, 0)
    assert text(table.rows()) == before


def test_late_rows_are_left_out_only_with_marks_and_counted(table, feed):
    table.load(feed(row("A", executed_at="2024-04-02")), "one")
    late = feed(row("L", executed_at="2024-04-01"), row("N", executed_at="2024-04-02"))
    found = table.load(late, "two", source_watermarks(table.rows()))
    assert (found.rows_in, found.rows_late, found.rows_upserted) == (2, 1, 1)
    assert {r.trade_id for r in table.rows().collect()} == {"A", "N"}
    assert table.load(late, "three").rows_late == 0
    assert {r.trade_id for r in table.rows().collect()} == {"A", "N", "L"}


def test_each_row_is_held_to_the_mark_of_its_own_source(table, feed, spark):
    table.load(feed(row("F1", executed_at="2024-04-20"), source="fast"), "one")
    table.load(feed(row("S1", executed_at="2024-04-02"), source="slow"), "two")
    marks = source_watermarks(table.rows())
    slow = feed(row("S0", executed_at="2024-04-01"), row("S2", executed_at="2024-04-03"), source="slow")
    fast = feed(row("F0", executed_at="2024-04-19"), row("F2", executed_at="2024-04-20"), source="fast")
    new = feed(row("N", executed_at="2020-01-01"), source="new")
    unnamed = feed(row("U", executed_at="2020-01-01"), row("V", executed_at="")).withColumn(
        "source_file", F.lit(None).cast("string")
    )
    batch = slow.unionByName(fast).unionByName(new).unionByName(unnamed)
    found = table.load(batch, "three", marks)
    assert (found.rows_in, found.rows_late, found.rows_upserted) == (7, 2, 5)
    assert {r.trade_id for r in table.rows().collect()} == {"F1", "S1", "S2", "F2", "N", "U", "V"}
    assert table.load(batch, "four", marks.limit(0)).rows_late == 0


@pytest.mark.parametrize("step", ["write", "add", "commit"])
def test_a_load_stopped_between_its_steps_leaves_the_old_state(table, feed, monkeypatch, step):
    table.load(feed(row("A", executed_at="2024-04-01"), row("B", executed_at="2024-04-02")), "one")
    before = text(table.rows())
    moved = feed(row("A", executed_at="2024-04-03"), row("", executed_at="2024-04-02"))

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        owner = table.index if step == "add" else table.store
        done = getattr(owner, step)
        # What the step does is done, or not, when the load stops.
        patch.setattr(owner, step, stop if step == "commit" else lambda *a: (done(*a), stop()))
        with pytest.raises(RuntimeError):
            table.load(moved, "two")
    assert text(table.rows()) == before
    assert table.store.versions() == [1]
    again = table.load(moved, "two")
    assert again.version == 3  # the number of the stopped one is not used again
    assert {str(r[DAY]) for r in again.days.collect()} == {"2024-04-01", "2024-04-02", "2024-04-03"}
    days = {r.trade_id: str(r.executed_at)[:10] for r in table.rows().collect()}
    assert days == {"A": "2024-04-03", "B": "2024-04-02", None: "2024-04-02"}
    assert text(table.rows(1)) == before


def test_touched_days_refresh_the_daily_figures(spark, table, feed, instruments, tmp_path):
    path = str(tmp_path / "daily")
    first = table.load(feed(row("A", executed_at="2024-04-01"), row("B", executed_at="2024-04-02")), "one")
    refresh_daily(table.rows(), instruments, path, days=first.days)
    moved = table.load(feed(row("A", executed_at="2024-04-03")), "two")
    refresh_daily(table.rows(), instruments, path, days=moved.days)
    found = {str(r.trade_date): r.trades for r in read_daily(spark, path).collect()}
    assert found == {"2024-04-02": 1, "2024-04-03": 1}


def test_a_small_load_reads_touched_days_and_shuffles_no_stored_trade(table, feed):
    days = [f"2024-04-0{d}" for d in range(1, 6)]
    table.load(feed(*(row(f"T{d}", executed_at=d) for d in days)), "one")
    before = table.store.manifest()
    arrived = table.store.rows().where(F.col("trade_id") == "T2024-04-02")
    merged = table.merged(before, arrived, ["2024-04-02"], "two", True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    kept = plan.split("BroadcastHashJoin")[1].split("BroadcastExchange")[0]
    assert "LeftAnti" in kept and "Exchange" not in kept
    files = table.store.rows_of(before, ["2024-04-02"]).inputFiles()
    assert files and all(f"{DAY}=2024-04-02/" in f for f in files)


def test_freshness_of_the_stored_table(table, feed):
    rule = next(r for r in trade_rules() if r.name == "feed_is_fresh")
    assert table.freshness(rule, "2024-05-02").first().rows_checked == 0
    table.load(feed(row("A", executed_at="2024-04-01"), row("B", executed_at="2024-04-03"), row("C", executed_at="")), "one")
    found, scanned = table.freshness(rule, "2024-05-02").first(), feed_freshness(table.rows(), rule, "2024-05-02").first()
    assert (found.newest, found.days_since_latest, found.success) == tuple(scanned)
    assert found.rows_checked == 3
