import pytest
from pyspark.sql import functions as F

from feedsieve.operators import labels, load as loading, quarantine as q
from feedsieve.rules import exists_in, positive, predicate, row_rules, table_rules, trade_rules
from feedsieve.schemas import rejected_schema

from .conftest import NOW, as_dict, row

RULES = trade_rules()


def reasons(trades, instruments, rules=RULES):
    rejected = labels.failing_rows(trades, instruments, rules)
    return as_dict(rejected, "trade_id", "reasons")


def test_good_rows_are_left_alone(load, instruments):
    assert reasons(load(row("G1"), row("G2")), instruments) == {}


def test_valid_and_rejected_rows_part_the_batch(load, instruments):
    sound = [row(f"s{i}", quantity=i) for i in range(1, 5)]
    trades = load(*sound, row("short", quantity=-9), row("nowhere", instrument_id=31))
    assert reasons(trades, instruments) == {
        "short": ["quantity_positive"],
        "nowhere": ["instrument_exists"],
    }
    valid = labels.valid_rows(trades, instruments, RULES)
    assert {r.trade_id for r in valid.collect()} == {"s1", "s2", "s3", "s4"}


def test_every_reason_is_recorded_in_declaration_order(load, instruments):
    broken = {"instrument_id": "", "executed_at": "noon", "quantity": 0, "price": "-2", "side": "hold"}
    assert reasons(load(row("all", **broken), row("none")), instruments) == {
        "all": [
            "instrument_id_present",
            "executed_at_present",
            "quantity_positive",
            "price_positive",
            "side_recognised",
        ]
    }


@pytest.mark.parametrize(
    ("fault", "expected"),
    [
        ({"instrument_id": ""}, "instrument_id_present"),
        ({"price": ""}, "price_present"),
        ({"quantity": ""}, "quantity_present"),
        ({"executed_at": ""}, "executed_at_present"),
        ({"quantity": 0}, "quantity_positive"),
        ({"quantity": -1}, "quantity_positive"),
        ({"price": "0"}, "price_positive"),
        ({"price": "-0.000001"}, "price_positive"),
        ({"side": ""}, "side_present"),
        ({"side": "X"}, "side_recognised"),
        ({"side": " BUY"}, "side_recognised"),
        ({"instrument_id": 58}, "instrument_exists"),
        ({"price": "ten"}, "price_present"),
        ({"executed_at": "yesterday"}, "executed_at_present"),
    ],
)
def test_single_faults(load, instruments, fault, expected):
    assert reasons(load(row("T", **fault), row("G")), instruments) == {"T": [expected]}


def test_letter_case_of_side_is_accepted(load, instruments):
    assert reasons(load(row("A", side="buy"), row("B", side="Sell")), instruments) == {}


def test_with_reasons_keeps_every_row(load, instruments):
    trades = load(row("G"), row("B", price=""), row("O", instrument_id=9))
    labelled = labels.with_reasons(trades, instruments, RULES)
    assert labelled.columns == [*trades.columns, "reasons"]
    assert as_dict(labelled, "trade_id", "reasons") == {
        "G": [],
        "B": ["price_present"],
        "O": ["instrument_exists"],
    }


def test_duplicate_reference_keys_do_not_multiply_rows(load, instruments):
    doubled = instruments.unionByName(instruments)
    trades = load(row("A"), row("B", instrument_id=2))
    assert labels.with_reasons(trades, doubled, RULES).count() == 2


def test_null_reference_keys_match_nothing(spark, load, instruments):
    lacking = instruments.unionByName(
        instruments.limit(1).withColumn("instrument_id", F.lit(None).cast("int"))
    )
    assert reasons(load(row("A", instrument_id="")), lacking) == {"A": ["instrument_id_present"]}


def test_no_row_rules_is_an_error(load, instruments):
    with pytest.raises(ValueError, match="no quarantinable rules"):
        labels.with_reasons(load(row("A")), instruments, table_rules(RULES))


def test_unknown_reference_table_is_an_error(load, instruments):
    rule = exists_in("venue_known", "side", "venue", "venue", "x")
    with pytest.raises(ValueError, match="venue"):
        labels.with_reasons(load(row("A")), instruments, [rule])


def test_every_row_rule_reaches_the_label(load, instruments):
    labelled = labels.with_reasons(load(row("A")), instruments, RULES)
    plan = labelled._jdf.queryExecution().optimizedPlan().toString()
    assert all(r.name in plan for r in row_rules(RULES))


def test_extra_rules_extend_the_quarantine(load, instruments):
    extra = [
        predicate("big", "quantity * price > 5000", "x", "value_range", ["quantity", "price"]),
        positive("id_positive", "instrument_id", "x"),
    ]
    trades = load(row("A", quantity=600), row("B", instrument_id=-1), row("C"))
    assert reasons(trades, instruments, [*RULES, *extra]) == {
        "A": ["big"],
        "B": ["instrument_exists", "id_positive"],
    }


def test_a_null_predicate_is_no_failure(load, instruments):
    rule = predicate("cheap", "price < 1", "x", "value_range", ["price"])
    trades = load(row("A", price=""), row("B", price="0.5"), row("C"))
    assert reasons(trades, instruments, [rule]) == {"B": ["cheap"]}
    assert {r.trade_id for r in labels.valid_rows(trades, instruments, [rule]).collect()} == {
        "A",
        "C",
    }
    assert labels.batch_split(trades, instruments, [rule]).first().rows_valid == 2


def test_two_reference_rules_on_different_tables(spark, load, instruments):
    sides = spark.createDataFrame([("BUY",), ("SELL",)], "code string")
    rule = exists_in("side_known", "side", "sides", "code", "x")
    trades = load(row("A", side="buy"), row("B", side="BUY", instrument_id=7))
    found = reasons(trades, {"instrument": instruments, "sides": sides}, [*RULES, rule])
    assert found == {"A": ["side_known"], "B": ["instrument_exists"]}


def test_missing_columns_are_left_out_of_the_label(load, instruments):
    trades = load(row("A", price="", side="X")).drop("price")
    assert reasons(trades, instruments) == {"A": ["side_recognised"]}


def test_quarantine_layout(load, instruments):
    trades = load(row("A", price=""), source="morning.csv")
    rejected = q.quarantine(trades, instruments, RULES, "r1", NOW)
    assert [(f.name, f.dataType) for f in rejected.schema] == [
        (f.name, f.dataType) for f in rejected_schema()
    ]
    record = rejected.first()
    assert (record.run_id, record.rejected_at, record.source_file) == ("r1", NOW, "morning.csv")


def test_quarantine_of_a_table_lacking_columns_keeps_the_layout(load, instruments):
    trades = load(row("A", price="", side="X")).drop("price", "source_file")
    rejected = q.quarantine(trades, instruments, RULES, "r1", NOW)
    assert rejected.columns == rejected_schema().fieldNames()
    assert rejected.first().price is None


def test_quarantining_twice_converges(load, instruments):
    trades = load(row("BAD", price=""))
    first = q.quarantine(trades, instruments, RULES, "r1", NOW)
    second = q.quarantine(trades, instruments, RULES, "r2", NOW)
    after = q.quarantine_upsert(first, second)
    assert [(r.trade_id, r.run_id) for r in after.collect()] == [("BAD", "r2")]


def test_partly_repaired_row_updates_its_record(load, instruments):
    before = q.quarantine(load(row("F", price="", quantity=-1)), instruments, RULES, "r1", NOW)
    again = q.quarantine(load(row("F", quantity=-1)), instruments, RULES, "r2", NOW)
    after = q.quarantine_upsert(before, again).first()
    assert (after.reasons, after.run_id) == (["quantity_positive"], "r2")


def test_fully_repaired_row_keeps_its_old_record(load, instruments):
    before = q.quarantine(load(row("F", price="")), instruments, RULES, "r1", NOW)
    again = q.quarantine(load(row("F")), instruments, RULES, "r2", NOW)
    after = q.quarantine_upsert(before, again).collect()
    assert [(r.trade_id, r.run_id, r.reasons) for r in after] == [("F", "r1", ["price_present"])]


def test_reason_counts_and_totals(load, instruments):
    lines = [row(f"cheap-{i}", price=f"-{i}") for i in range(1, 6)]
    lines += [row(f"lost-{i}", instrument_id=30 + i, side="") for i in range(3)]
    lines += [row(f"sound-{i}") for i in range(2)]
    trades = load(*lines)
    rejected = q.quarantine(trades, instruments, RULES, "r1", NOW)
    expected = {"price_positive": 5, "instrument_exists": 3, "side_present": 3}
    assert as_dict(q.reason_counts(rejected), "reason", "n") == expected
    assert as_dict(q.rows_rejected(rejected), "run_id", "rows_rejected") == {"r1": 8}
    assert q.rows_rejected(rejected, "other").count() == 0
    result = q.quarantine_result(rejected, RULES).first()
    assert result.rows_rejected == 8
    assert [(c.reason, c.n) for c in result.reason_counts] == sorted(expected.items())
    split = labels.batch_split(trades, instruments, RULES).first()
    assert (split.rows_total, split.rows_valid, split.rows_rejected) == (10, 2, 8)


def test_rejected_rows_without_an_id_stay(load, instruments):
    trades = load(row(None, price=""), row(None, side=""), row("A", price=""))
    first = q.quarantine(trades, instruments, RULES, "r1", NOW)
    second = q.quarantine(trades, instruments, RULES, "r2", NOW)
    current = q.current_rejected(first.unionByName(second))
    assert current.count() == 3
    assert {r.run_id for r in current.collect()} == {"r2"}
    assert q.quarantine_upsert(first, second).count() == 3


def test_columns_named_like_those_of_a_record_are_not_copied(load, instruments):
    trades = load(row("A", price=""), row("B"))
    for name in ("reasons", "run_id", "rejected_at"):
        found = q.quarantine(trades.withColumn(name, F.lit("?")), instruments, RULES, "r1", NOW)
        assert [(r.trade_id, r.reasons, r.run_id) for r in found.collect()] == [
            ("A", ["price_present"], "r1")
        ]


def test_worst_reason_breaks_ties_by_name(load, instruments):
    trades = load(row("A", price=""), row("B", quantity=0))
    counts = q.reason_counts(labels.failing_rows(trades, instruments, RULES))
    assert tuple(q.worst_reason(counts).first()) == ("price_present", 1)


def test_worst_reason_of_clean_data(load, instruments):
    counts = q.reason_counts(labels.failing_rows(load(row("A")), instruments, RULES))
    assert tuple(q.worst_reason(counts).first()) == ("none", 0)


def test_orphans(load, instruments):
    trades = load(
        row("A"), row("B", instrument_id=7), row("C", instrument_id=7), row("D", instrument_id="")
    )
    assert {tuple(r) for r in q.orphan_trades(trades, instruments).collect()} == {
        ("B", 7),
        ("C", 7),
    }
    assert as_dict(q.orphan_keys(trades, instruments), "instrument_id", "n") == {7: 2}


def test_orphans_are_labelled_again_when_their_reference_arrives(spark, load, instruments):
    trades = load(
        row("A", instrument_id=7),
        row("B", instrument_id=7, price=""),
        row("C", instrument_id=8),
        row("D", price=""),
        row("", instrument_id=7),
    )
    records = q.quarantine(trades, instruments, RULES, "run-1", NOW)
    arrived = spark.createDataFrame([(7,), (7,), (1,), (None,)], "instrument_id int")
    found = q.resolve_orphans(records, arrived, "instrument_exists", "run-2", NOW)
    assert set(found.columns) == {*records.columns, "resolved"}
    got = {r.trade_id: (r.reasons, r.resolved, r.run_id) for r in found.collect()}
    assert got == {
        "A": ([], True, "run-2"),
        "B": (["price_present"], False, "run-2"),
        None: ([], True, "run-2"),
    }
    # What is left is what labelling the trades with all references gives.
    again = q.quarantine(trades, instruments.unionByName(arrived, True), RULES, "run-2", NOW)
    left = as_dict(again.where("instrument_id = 7"), "trade_id", "reasons")
    assert left == {"B": ["price_present"]}


def test_current_rejected_takes_the_latest_record(load, instruments):
    later = NOW.replace(hour=13)
    records = (
        q.quarantine(load(row("A", price=""), row("B", side="X")), instruments, RULES, "r9", NOW)
    ).unionByName(q.quarantine(load(row("A", quantity=0)), instruments, RULES, "r1", later))
    current = as_dict(q.current_rejected(records), "trade_id", "reasons")
    assert current == {"A": ["quantity_positive"], "B": ["side_recognised"]}


def test_offenders_read_only_what_the_rule_needs(load, instruments):
    rule = next(r for r in RULES if r.name == "price_positive")
    found = labels.offenders(load(row("A", price="-1"), row("B")), instruments, rule, ["trade_id"])
    assert [tuple(r) for r in found.collect()] == [("A",)]


def test_load_layouts_match(load):
    assert loading.RESEND_ORDER[0] == "executed_at"
    assert load(row("A")).schema["price"].dataType.simpleString() == "decimal(18,6)"
