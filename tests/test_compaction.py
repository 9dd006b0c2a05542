"""The quarantine as a snapshot and the runs since."""

import datetime as dt
import os

import pytest

from feedsieve.operators.quarantine import current_rejected, quarantine
from feedsieve.rules import trade_rules
from feedsieve.sources.tables import QualityTables

from .conftest import NOW, row

RULES = trade_rules()


@pytest.fixture()
def tables(spark, tmp_path):
    owned = QualityTables(spark, str(tmp_path / "quality"))
    owned.ensure()
    return owned


@pytest.fixture()
def reject(tables, load, instruments):
    def run(number, *lines):
        stamp = NOW + dt.timedelta(hours=number)
        tables.write_rejected(quarantine(load(*lines), instruments, RULES, f"run {number}/x", stamp))

    return run


def whole(tables):
    """The current quarantine from every run ever made."""
    return text(current_rejected(tables.rejected()))


def text(rows):
    return sorted(map(str, rows.collect()))


def break_run(tables, number):
    """A run whose files can no longer be read."""
    root = tables.path("rejected_trades")
    folder = next(f for f in os.listdir(root) if f.startswith(f"run_id=run {number}") or f.startswith(f"run_id=run%20{number}"))
    for name in os.listdir(f"{root}/{folder}"):
        if name.endswith(".parquet"):
            with open(f"{root}/{folder}/{name}", "wb") as file:
                file.write(b"no parquet")


def test_snapshot_and_later_runs_equal_all_runs(tables, reject):
    assert tables.current_rejected().collect() == [] and tables.compact_rejected() == 0
    reject(1, row("A", price=""), row("B", side="X"), row("", quantity=0), row("", price=""))
    assert text(tables.current_rejected()) == whole(tables)
    assert tables.compact_rejected() == 1
    reject(2, row("B", quantity=-1), row("C", price=""), row("", quantity=0))
    expected = whole(tables)
    assert text(tables.current_rejected()) == expected
    assert tables.compact_rejected() == 2
    assert text(tables.current_rejected()) == expected
    assert {r.trade_id for r in tables.rejected_trade("B").collect()} == {"B"}
    assert tables.rejected_trade("B").first().reasons == ["quantity_positive"]
    assert tables.rejected_trade("Z").collect() == []


def test_compacted_runs_are_not_read(tables, reject):
    reject(1, row("A", price=""), row("B", side="X"))
    tables.compact_rejected()
    reject(2, row("B", quantity=-1))
    expected = whole(tables)
    break_run(tables, 1)
    assert text(tables.current_rejected()) == expected
    plan = tables.current_rejected()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan or "PartitionFilters: [(run_id" in plan


def test_repeating_a_compacted_run_replaces_its_records(tables, reject):
    reject(1, row("A", price=""), row("B", side="X"))
    reject(2, row("C", side="X"))
    tables.compact_rejected()
    reject(1, row("A", quantity=0))
    assert {r.trade_id: r.reasons for r in tables.current_rejected().collect()} == {
        "A": ["quantity_positive"],
        "C": ["side_recognised"],
    }
    tables.compact_rejected()
    tables.clear_rejected("run 2/x")
    assert {r.trade_id for r in tables.current_rejected().collect()} == {"A"}


def test_a_compaction_that_stops_leaves_the_old_snapshot(tables, reject, monkeypatch):
    reject(1, row("A", price=""))
    tables.compact_rejected()
    reject(2, row("A", side="X"))
    expected = whole(tables)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(tables.snapshot, "commit", stop)
        with pytest.raises(RuntimeError):
            tables.compact_rejected()
    assert text(tables.current_rejected()) == expected
    assert tables.compact_rejected() == 2 and text(tables.current_rejected()) == expected


def test_reset_and_drop_remove_the_snapshot(tables, reject):
    reject(1, row("A", price=""))
    tables.compact_rejected()
    tables.reset()
    assert tables.current_rejected().collect() == []
    tables.drop()
    tables.ensure()
    assert tables.current_rejected().collect() == []
