import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from feedsieve.operators import runs as R
from feedsieve.operators.labels import valid_rows
from feedsieve.operators.pnl import daily_pnl, touched_days
from feedsieve.plans.quality_run import read_daily, refresh_daily, run_quality
from feedsieve.rules import trade_rules
from feedsieve.schemas import rejected_schema, run_schema
from feedsieve.sources.tables import QualityTables

from .conftest import AS_OF, NOW, as_dict, row

RULES = trade_rules()
STARTS = "run_id string, started_at timestamp"


def at(hour):
    return NOW.replace(hour=hour)


def state(run_id, started=None, finished=None, status="running", checked=0, rejected=0):
    return (run_id, started, finished, status, checked, rejected, 12, 1, "{}")


@pytest.fixture()
def tables(spark, tmp_path):
    made = QualityTables(spark, str(tmp_path / "quality"))
    made.ensure()
    return made


def test_starting_twice_changes_nothing(spark):
    runs = spark.createDataFrame([state("a", at(1))], run_schema())
    starts = spark.createDataFrame([("a", at(5)), ("b", at(6))], STARTS)
    after = as_dict(R.start_run(runs, starts), "run_id", "started_at")
    assert after == {"a": at(1), "b": at(6)}


def test_finishing_keeps_the_start(spark):
    states = [state("a", at(1)), state("a", None, at(2), "failed", 10, 3)]
    run = R.fold_runs(spark.createDataFrame(states, run_schema())).first()
    assert (run.started_at, run.finished_at) == (at(1), at(2))
    assert (run.status, run.rows_checked, run.rows_rejected) == ("failed", 10, 3)


def test_a_run_never_started_began_when_it_finished(spark):
    states = [state("a", None, at(2), "passed", 10)]
    assert R.fold_runs(spark.createDataFrame(states, run_schema())).first().started_at == at(2)


def test_start_after_finish_changes_nothing(spark):
    states = [state("a", None, at(2), "passed", 10), state("a", at(3))]
    run = R.fold_runs(spark.createDataFrame(states, run_schema())).first()
    assert (run.status, run.started_at, run.finished_at) == ("passed", at(2), at(2))


def test_finishing_again_replaces_the_result(spark):
    states = [
        state("a", at(1)),
        state("a", None, at(2), "passed", 99, 9),
        state("a", None, at(3), "failed", 5, 1),
    ]
    run = R.fold_runs(spark.createDataFrame(states, run_schema())).first()
    assert (run.status, run.rows_checked, run.finished_at) == ("failed", 5, at(3))


def test_recent_runs_order_and_limit(spark):
    states = [state(f"r{i:02}", at(i % 4), at(5), "passed", i) for i in range(12)]
    runs = R.fold_runs(spark.createDataFrame(states, run_schema()))
    recent = [r.run_id for r in R.recent_runs(runs).collect()]
    assert recent == ["r11", "r07", "r03", "r10", "r06", "r02", "r09", "r05", "r01", "r08"]
    assert [r.run_id for r in R.recent_runs(runs, 1).collect()] == ["r11"]
    assert R.history_lines(runs, 1).first().line == (
        "r11  passed  checked=11      rejected=0     rules_failed=1"
    )


def test_rejection_trend(spark):
    states = [
        state("a", at(1), at(1), "failed", 100, 10),
        state("b", at(2), at(2), "failed", 100, 25),
        state("c", at(3), at(3), "failed", 0, 0),
        state("d", at(4)),
    ]
    rows = R.rejection_trend(spark.createDataFrame(states, run_schema())).collect()
    assert [(r.run_id, r.rate, r.change and round(r.change, 9)) for r in rows] == [
        ("a", 0.1, None),
        ("b", 0.25, 0.15),
        ("c", None, None),
    ]


def test_tables_are_created_once_and_reset(spark, tables, load, instruments):
    assert tables.rejected().schema.fieldNames() == rejected_schema().fieldNames()
    assert (tables.rejected().count(), tables.runs().count()) == (0, 0)
    run_quality(load(row("A", price="")), instruments, tables, as_of=AS_OF, now=NOW)
    tables.ensure()
    assert (tables.rejected().count(), tables.runs().count()) == (1, 1)
    tables.reset()
    assert (tables.rejected().count(), tables.runs().count()) == (0, 0)
    tables.reset()


def test_a_run_is_recorded_with_its_breakdown(tables, load, instruments):
    outcome = run_quality(
        load(row("G"), row("B", price="")), instruments, tables, run_id="r1", as_of=AS_OF, now=NOW
    )
    assert (outcome.success, outcome.rows_checked, outcome.rows_rejected) == (False, 2, 1)
    assert outcome.failed_rules == ["price_present"]
    assert outcome.reason_counts == {"price_present": 1}
    assert outcome.summary == "1 of 12 rules failed over 2 rows: price_present"
    assert outcome.quarantine_summary == "quarantined 1 rows (price_present=1)"
    run = tables.runs().first()
    assert (run.status, run.rows_checked, run.rows_rejected) == ("failed", 2, 1)
    assert (run.rules_total, run.rules_failed) == (12, 1)
    assert (run.started_at, run.finished_at) == (NOW, NOW)
    details = json.loads(run.details)
    assert details["reason_counts"] == {"price_present": 1}
    assert details["rules"]["price_present"] == {
        "success": False,
        "category": "completeness",
        "observed": 1,
    }
    assert len(details["rules"]) == 12
    assert details["rules"]["schema_unchanged"]["observed"][0] == "trade_id"


def test_clean_run(tables, load, instruments):
    outcome = run_quality(load(row("A")), instruments, tables, as_of=AS_OF, now=NOW)
    assert outcome.success and outcome.rows_rejected == 0 and outcome.reason_counts == {}
    assert outcome.summary == "all 12 rules passed over 1 rows"
    assert outcome.quarantine_summary == "no rows quarantined"
    run = tables.recent_runs(1).first()
    assert (run.run_id, run.status) == (outcome.run_id, "passed")


@pytest.mark.parametrize(
    ("when", "faulty", "stored"),
    [("always", True, 1), ("on_failure", True, 1), ("on_failure", False, 0), ("never", True, 0)],
)
def test_verdict_routing(tables, load, instruments, when, faulty, stored):
    trades = load(row("A", price="" if faulty else "1"))
    outcome = run_quality(
        trades, instruments, tables, as_of=AS_OF, now=NOW, quarantine_when=when
    )
    assert tables.rejected().count() == stored == outcome.rows_rejected


def test_daily_refresh_replaces_only_its_days(spark, load, instruments, tmp_path):
    path = str(tmp_path / "daily")

    def stored():
        return {str(r.trade_date): r.net_qty for r in read_daily(spark, path).collect()}

    first = load(
        row("A", quantity=1, executed_at="2024-04-01"),
        row("B", quantity=2, executed_at="2024-04-02"),
        row("C", quantity=3, executed_at="2024-04-03"),
        row("X", price="", executed_at="2024-04-04"),
        row("Y", executed_at=""),
    )
    refresh_daily(first, instruments, path)
    assert stored() == {"2024-04-01": 1, "2024-04-02": 2, "2024-04-03": 3}
    again = load(
        row("B", quantity=5, executed_at="2024-04-02"),
        row("C", quantity=-3, executed_at="2024-04-03"),
    )
    refresh_daily(again, instruments, path)
    assert stored() == {"2024-04-01": 1, "2024-04-02": 5}


def test_daily_refresh_equals_the_daily_query(spark, load, instruments, tmp_path):
    path = str(tmp_path / "daily")
    trades = load(row("A"), row("B", side="SELL", price="7"), row("C", price=""))
    refresh_daily(trades, instruments, path)
    expected = daily_pnl(valid_rows(trades, instruments, RULES))
    got = read_daily(spark, path).select(*expected.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_clean_rows_start_no_quarantine(tables, load, instruments, monkeypatch):
    monkeypatch.setattr(tables, "write_rejected", lambda rows: pytest.fail("nothing to copy"))
    outcome = run_quality(
        load(row("A"), row("B")), instruments, tables, as_of=AS_OF, now=NOW
    )
    assert outcome.rows_rejected == 0
    assert tables.rejected().count() == 0


def test_a_repeated_run_replaces_what_it_rejected(tables, load, instruments):
    at = {"run_id": "again", "as_of": AS_OF, "now": NOW}
    assert run_quality(load(row("A", price="")), instruments, tables, **at).rows_rejected == 1
    repeated = run_quality(load(row("A")), instruments, tables, **at)
    assert (repeated.success, repeated.rows_rejected) == (True, 0)
    assert tables.rejected("again").count() == 0
    # Both finished at the same time: the failure stays on record.
    assert [r.status for r in tables.recent_runs().collect()] == ["failed"]


def test_a_moved_trade_leaves_its_old_day(spark, load, instruments, tmp_path):
    path = str(tmp_path / "daily")
    before = load(row("A", executed_at="2024-04-01"), row("B", executed_at="2024-04-02"))
    after = load(row("A", executed_at="2024-04-03"), row("B", executed_at="2024-04-02"))
    refresh_daily(before, instruments, path)
    days = touched_days(before, after)
    assert {str(r.trade_date) for r in days.collect()} == {"2024-04-01", "2024-04-03"}
    refresh_daily(after, instruments, path, days=days)
    found = {str(r.trade_date): r.trades for r in read_daily(spark, path).collect()}
    assert found == {"2024-04-02": 1, "2024-04-03": 1}


def test_dropped_tables_are_gone_and_can_be_made_again(tables, load, instruments):
    run_quality(load(row("A")), instruments, tables, as_of=AS_OF, now=NOW)
    tables.drop()
    tables.ensure()
    assert tables.runs().count() == 0


def test_unknown_routing_is_an_error(tables, load, instruments):
    with pytest.raises(ValueError, match="quarantine_when"):
        run_quality(load(row("A")), instruments, tables, quarantine_when="perhaps")


def test_failing_only_table_rules_quarantines_nothing(tables, load, instruments):
    trades = load(row("A", executed_at="2019-01-01"))
    outcome = run_quality(
        trades, instruments, tables, as_of=AS_OF, now=NOW, quarantine_when="on_failure"
    )
    assert outcome.failed_rules == ["feed_is_fresh"]
    assert (outcome.rows_rejected, tables.rejected().count()) == (0, 0)


def test_missing_column_does_not_stop_the_run(tables, load, instruments):
    trades = load(row("A", side="X")).drop("price")
    outcome = run_quality(trades, instruments, tables, run_id="r", as_of=AS_OF, now=NOW)
    assert outcome.failed_rules == [
        "price_positive",
        "price_present",
        "schema_unchanged",
        "side_recognised",
    ]
    assert outcome.reason_counts == {"side_recognised": 1}
    observed = json.loads(tables.runs().first().details)["rules"]["price_present"]["observed"]
    assert observed is None


def test_repeating_a_run_converges(tables, load, instruments):
    trades = load(row("A", price=""), row("B", side="X"))
    for hour in (1, 2):
        run_quality(trades, instruments, tables, run_id="same", as_of=AS_OF, now=at(hour))
    assert tables.rejected().count() == 2
    run = tables.runs().collect()
    assert [(r.run_id, r.started_at, r.finished_at) for r in run] == [("same", at(1), at(2))]


def test_later_runs_take_over_and_repaired_rows_stay(tables, load, instruments):
    first = load(row("A", price="", quantity=-1), row("B", side="X"))
    second = load(row("A", quantity=-1), row("B"))
    run_quality(first, instruments, tables, run_id="r1", as_of=AS_OF, now=at(1))
    run_quality(second, instruments, tables, run_id="r2", as_of=AS_OF, now=at(2))
    current = {r.trade_id: (r.run_id, r.reasons) for r in tables.current_rejected().collect()}
    assert current == {
        "A": ("r2", ["quantity_positive"]),
        "B": ("r1", ["side_recognised"]),
    }
    assert tables.rejected("r1").count() == 2
    assert [r.run_id for r in tables.recent_runs().collect()] == ["r2", "r1"]


def test_counts_are_read_back_from_the_table(spark, tables, load, instruments):
    from feedsieve.operators.quarantine import quarantine
    from feedsieve.operators.report import rule_report

    trades = load(row("G"), row("B", price=""), row("W", quantity=-1))
    tables.write_rejected(quarantine(trades, instruments, RULES, "r1", NOW))
    tables.finish_run("r1", rule_report(trades, instruments, RULES, AS_OF), RULES, NOW)
    assert tables.recent_runs(1).first().rows_rejected == 2


def test_crashed_run_stays_visible(tables):
    tables.start_run("gone", NOW)
    assert [(r.run_id, r.status) for r in tables.recent_runs().collect()] == [("gone", "running")]


def test_reading_one_run_prunes_partitions(tables, load, instruments):
    run_quality(load(row("A", price="")), instruments, tables, run_id="r1", as_of=AS_OF, now=NOW)
    plan = tables.rejected("r1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_stored_watermarks(tables, load):
    tables.advance_watermarks(load(row("A", executed_at="2024-04-05"), source="x"))
    tables.advance_watermarks(load(row("B", executed_at="2024-04-01"), source="x"))
    assert as_dict(tables.watermarks(), "source_file", "high_watermark") == {
        "x": dt.datetime(2024, 4, 5)
    }


def test_details_of_a_run_without_rejects(spark, load, instruments):
    from feedsieve.operators.quarantine import quarantine, quarantine_result
    from feedsieve.operators.report import rule_report

    trades = load(row("A"))
    report = rule_report(trades, instruments, RULES, AS_OF).withColumn("run_id", F.lit("r"))
    result = quarantine_result(
        quarantine(trades, instruments, RULES, "r", NOW), RULES, ["run_id"]
    )
    document = json.loads(R.run_results(report, result).first().details)
    assert document["reason_counts"] == {}


def test_cusum_equals_adding_up_run_by_run(spark):
    rates = [10, 12, 11, 30, 9, 0, 14, 15, 16, 17, 18, 2, 0, 0, 0]
    states = [
        state(f"r{i:02d}", NOW + dt.timedelta(i), NOW + dt.timedelta(i), "failed", 1000, n) for i, n in enumerate(rates)
    ]
    states += [state("open", NOW), state("empty", NOW, NOW, "passed", 0)]
    runs = spark.createDataFrame(states, run_schema())
    found = sorted(R.rejection_alarm(runs, baseline=3, slack_ppm=500, limit_ppm=9_000).collect(), key=lambda r: r.run_id)
    level, expected = 0, sum(rates[:3]) * 1000 // 3
    assert [r.run_id for r in found] == [f"r{i:02d}" for i in range(len(rates))]
    for rate, row_ in zip(rates, found, strict=True):
        level = max(0, level + rate * 1000 - expected - 500)
        assert (row_.expected_ppm, row_.cusum_ppm, row_.alarm) == (expected, level, level > 9_000)
    assert {r.alarm for r in found} == {True, False}
    assert R.rejection_alarm(runs.limit(0)).collect() == []


def test_rule_results_tell_since_when_a_rule_fails(tables, load, instruments):
    lines = {1: [row("A", price="")], 2: [row("A", price="")], 3: [row("A")], 4: [row("A", price="", side="")]}
    for number, batch in lines.items():
        run_quality(load(*batch), instruments, tables, RULES, f"r{number}", AS_OF, at(number))
    run_quality(load(row("A", price="")), instruments, tables, RULES, "r4", AS_OF, at(9))  # repeated
    found = {(r.run_id, r.rule): (r.success, r.failing_since) for r in tables.rule_results().collect()}
    assert len(found) == 4 * len(RULES)
    price = [found[f"r{n}", "price_present"] for n in range(1, 5)]
    assert price == [(False, "r1"), (False, "r1"), (True, None), (False, "r4")]
    assert found["r4", "side_present"] == (True, None)
