"""Shapes of the physical plans that matter at scale."""

import re

import pytest

from feedsieve.operators import labels, load as L, pnl, quarantine as q, report
from feedsieve.rules import trade_rules
from feedsieve.schemas import INSTRUMENT_SCHEMA, trade_schema

RULES = trade_rules()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Empty tables on disk: plans as over files, without rows."""
    root = tmp_path_factory.mktemp("stored")
    trades, instruments = str(root / "t"), str(root / "i")
    spark.createDataFrame([], trade_schema()).write.parquet(trades)
    spark.createDataFrame([], INSTRUMENT_SCHEMA).write.parquet(instruments)
    return spark.read.parquet(trades), spark.read.parquet(instruments)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_labelling_needs_one_join_and_no_shuffle_of_trades(stored):
    text = plan(labels.with_reasons(*stored, RULES))
    assert len(re.findall(r"\bBroadcastHashJoin\b", text)) == 1
    # The only exchange by key is that of the reference keys.
    assert text.count("Exchange hashpartitioning") == 1
    assert "hashpartitioning(_ref_0" in text


def test_labelling_is_compiled(stored):
    """No lambda-based array functions, which fall out of whole-stage codegen."""
    for df in (labels.with_reasons(*stored, RULES), labels.failing_rows(*stored, RULES)):
        assert "lambda" not in plan(df)


def test_failing_rows_filter_before_the_array_is_built(stored):
    text = plan(labels.failing_rows(*stored, RULES))
    assert text.index("concat(CASE") < text.index("Filter")


def test_valid_rows_push_their_filters_to_the_scan(stored):
    text = plan(labels.valid_rows(*stored, RULES))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    for column in ("price", "quantity", "executed_at", "side"):
        assert f"IsNotNull({column})" in pushed


def test_one_rule_reads_only_its_columns(stored):
    rule = next(r for r in RULES if r.name == "price_positive")
    text = plan(labels.offenders(*stored, rule, ["trade_id"]))
    assert re.search(r"ReadSchema: struct<([^>]*)>", text).group(1) == (
        "trade_id:string,price:decimal(18,6)"
    )
    assert "LessThanOrEqual(price" in text


def test_report_reads_each_column_once_and_the_key_alone(stored):
    text = plan(report.rule_report(*stored, RULES, "2024-05-02"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert "trade_id:string" in schemas
    assert not any("source_file" in s or "ingested_at" in s for s in schemas)


@pytest.mark.parametrize("case", ["collapse", "daily", "duplicates", "orphans", "reasons"])
def test_groups_are_combined_before_the_shuffle(stored, case):
    trades, instruments = stored
    df = {
        "collapse": lambda: L.collapse_retries(trades),
        "daily": lambda: pnl.daily_pnl(trades),
        "duplicates": lambda: report.duplicate_keys(trades),
        "orphans": lambda: q.orphan_keys(trades, instruments),
        "reasons": lambda: q.reason_counts(labels.failing_rows(trades, instruments, RULES)),
    }[case]()
    text = plan(df)
    below = text[text.index("Exchange hashpartitioning") :]
    assert "partial_" in below
