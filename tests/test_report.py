import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedsieve.functions.text import outcome_line
from feedsieve.operators import labels, quarantine as q, report
from feedsieve.operators.load import typed_feed
from feedsieve.rules import predicate, row_rules, trade_rules
from feedsieve.schemas import TRADE_COLUMNS, trade_schema
from feedsieve.sources.readers import read_query

from .conftest import AS_OF, as_dict, row

RULES = trade_rules()


def full(trades, instruments, rules=RULES, as_of=AS_OF):
    return report.rule_report(trades, instruments, rules, as_of)


def failed(trades, instruments, **more):
    return set(report.verdict(full(trades, instruments, **more)).first().failed_rules)


def test_clean_data_passes(load, instruments):
    result = report.verdict(full(load(row("A"), row("B"), row("C")), instruments)).first()
    assert (result.success, result.rows_checked) == (True, 3)
    assert (result.rules_total, result.rules_failed, result.failed_rules) == (12, 0, [])


@pytest.mark.parametrize(
    "faults",
    [
        {"side_recognised": {"side": "HOLD"}},
        {"executed_at_present": {"executed_at": "soon"}, "price_positive": {"price": "0"}},
        {
            "quantity_present": {"quantity": "many"},
            "instrument_id_present": {"instrument_id": ""},
            "instrument_exists": {"instrument_id": 31},
        },
    ],
)
def test_only_broken_rules_fail(load, instruments, faults):
    bad = [row(f"bad-{i}", **change) for i, change in enumerate(faults.values())]
    assert failed(load(row("sound"), *bad), instruments) == set(faults)


def test_report_and_quarantine_agree(load, instruments):
    lines = [
        row(f"{side}/{quantity}/{instrument}", side=side, quantity=quantity, instrument_id=instrument)
        for side in ("BUY", "sell", "", "?")
        for quantity in (7, 0, "")
        for instrument in (2, 31, "")
    ]
    trades = load(*lines)
    counts = q.reason_counts(labels.failing_rows(trades, instruments, RULES))
    agreement = report.rule_agreement(full(trades, instruments), counts).collect()
    assert len(agreement) == len(row_rules(RULES))
    assert all(r.agree for r in agreement)


def test_disagreement_is_visible(load, instruments):
    trades = load(row("A", price=""))
    empty = q.reason_counts(labels.failing_rows(load(row("B")), instruments, RULES))
    agreement = report.rule_agreement(full(trades, instruments), empty)
    assert as_dict(agreement, "rule", "agree")["price_present"] is False


def test_report_has_one_row_per_rule(load, instruments):
    rows = full(load(row("A", price="")), instruments).orderBy("position").collect()
    assert [r.rule for r in rows] == [r.name for r in RULES]
    assert [r.category for r in rows] == [r.category for r in RULES]
    by_rule = {r.rule: r for r in rows}
    assert by_rule["price_present"].observed == "1"
    assert by_rule["feed_is_fresh"].observed == "0"
    assert by_rule["schema_unchanged"].observed.startswith('["trade_id", ')
    assert {r.rows_checked for r in rows} == {1}


def test_duplicates_fail_uniqueness(feed, instruments):
    trades = typed_feed(feed(row("A"), row("A", price="11"), row("B"), row(None), row(None)))
    found = as_dict(full(trades, instruments), "rule", "failing_rows")
    assert found["trade_id_unique"] == 2
    summary = report.duplicate_summary(trades).first()
    assert tuple(summary) == (2, 1, 2, 5)
    assert as_dict(report.duplicate_keys(trades), "trade_id", "n") == {"A": 2}


@pytest.mark.parametrize("change", ["add", "drop", "rename"])
def test_schema_drift_is_detected(load, instruments, change):
    trades = load(row("A"))
    changed = {
        "add": trades.withColumn("venue", F.lit("X")),
        "drop": trades.drop("source_file"),
        "rename": trades.withColumnRenamed("source_file", "origin"),
    }[change]
    assert failed(changed, instruments) == {"schema_unchanged"}


def test_column_order_is_not_drift(load, instruments):
    trades = load(row("A"))
    assert failed(trades.select(*reversed(trades.columns)), instruments) == set()


def test_rules_of_a_missing_column_fail_without_breaking_the_run(load, instruments):
    trades = load(row("A"), row("B", side="X")).drop("price")
    rows = {r.rule: r for r in full(trades, instruments).collect()}
    assert rows["price_present"].success is False
    assert rows["price_present"].observed is None
    assert rows["side_recognised"].failing_rows == 1
    assert rows["schema_unchanged"].success is False


def test_missing_key_column(load, instruments):
    rows = {r.rule: r for r in full(load(row("A")).drop("trade_id"), instruments).collect()}
    assert (rows["trade_id_unique"].success, rows["trade_id_unique"].observed) == (False, None)


def test_drift_report_counts_filled_rows(load):
    trades = load(row("A"), row("B", price="")).withColumnRenamed("source_file", "origin")
    rows = {r.column_name: r for r in report.drift_report(trades, TRADE_COLUMNS).collect()}
    assert (rows["origin"].status, rows["origin"].rows_filled) == ("added", 2)
    assert (rows["source_file"].status, rows["source_file"].rows_filled) == ("missing", 0)
    assert (rows["price"].status, rows["price"].rows_filled) == ("expected", 1)


@pytest.mark.parametrize(
    ("executed", "fresh"),
    [
        ("2024-05-02 09:00:00", True),
        ("2023-03-29 23:59:59", True),  # 400 days
        ("2023-03-28 00:00:00", False),  # 401 days
        ("2021-11-14 00:00:00", False),
        ("2024-05-03 00:00:00", False),  # tomorrow
    ],
)
def test_freshness_limits(load, instruments, executed, fresh):
    trades = load(row("A", executed_at=executed))
    assert ("feed_is_fresh" not in failed(trades, instruments)) is fresh


def test_freshness_of_an_empty_table(spark, instruments):
    empty = spark.createDataFrame([], trade_schema())
    rule = next(r for r in RULES if r.kind == "fresh")
    result = report.feed_freshness(empty, rule, AS_OF).first()
    assert (result.newest, result.days_since_latest, result.success) == (None, 99999, False)
    outcome = report.verdict(full(empty, instruments)).first()
    assert (outcome.failed_rules, outcome.rows_checked) == (["feed_is_fresh"], 0)


def test_freshness_is_measured_from_today_by_default(load, instruments):
    today = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d 00:00:00")
    assert failed(load(row("A", executed_at=today)), instruments, as_of=None) == set()
    assert failed(load(row("A", executed_at="2020-01-01")), instruments, as_of=None) == {
        "feed_is_fresh"
    }


def test_only_the_given_rules_run(load, instruments):
    some = [r for r in RULES if r.name in ("price_present", "trade_id_unique")]
    rows = full(load(row("A", side="")), instruments, rules=some).collect()
    assert {r.rule for r in rows} == {"price_present", "trade_id_unique"}
    with pytest.raises(ValueError, match="no rules"):
        full(load(row("A")), instruments, rules=[])


def test_extra_rule_extends_the_report(load, instruments):
    extra = predicate("big", "quantity * price > 5000", "x", "value_range", ["quantity", "price"])
    assert failed(load(row("A", quantity=501)), instruments, rules=[*RULES, extra]) == {"big"}


def test_category_report(load, instruments):
    trades = load(row("A", price=""), row("B", quantity=""), row("C", quantity=0))
    rows = {r.category: r for r in report.category_report(full(trades, instruments)).collect()}
    assert len(rows) == 6
    assert (rows["completeness"].rules, rows["completeness"].rules_failed) == (5, 2)
    assert rows["completeness"].failing_rows == 2
    assert rows["uniqueness"].success is True


def test_row_count_of_a_query(spark, load, instruments):
    orphans = read_query(
        spark,
        "SELECT t.trade_id FROM {t} t LEFT ANTI JOIN {i} i ON i.instrument_id = t.instrument_id",
        t=load(row("A"), row("B", instrument_id=9)),
        i=instruments,
    )
    assert tuple(report.row_count_check(orphans, 0).first()) == (1, 0, False)
    assert report.row_count_check(orphans, 1).first().success is True


def test_outcome_lines(load, instruments):
    def line(*rows):
        return (
            report.verdict(full(load(*rows), instruments)).select(outcome_line()).first()[0]
        )

    assert line(row("A"), row("B")) == "all 12 rules passed over 2 rows"
    assert line(row("A", price=""), row("B", side="")) == (
        "2 of 12 rules failed over 2 rows: price_present, side_present"
    )


def test_grouped_report_equals_separate_reports(load, instruments):
    trades = load(
        row("A"), row("B", price=""), row("C", side="X", executed_at="2021-01-01"), row("D")
    ).withColumn("run_id", F.when(F.col("trade_id").isin("A", "B"), "x").otherwise("y"))
    grouped = report.rule_report(trades, instruments, RULES, AS_OF, by=["run_id"])
    for run in ("x", "y"):
        alone = full(trades.where(F.col("run_id") == run).drop("run_id"), instruments)
        part = grouped.where(F.col("run_id") == run).drop("run_id")
        assert sorted(map(tuple, part.collect())) == sorted(map(tuple, alone.collect()))
