"""Invariants over random batches, against a row-by-row reading of the rules."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feedsieve.operators import labels, quarantine as q, report
from feedsieve.operators.load import collapse_retries
from feedsieve.rules import row_rules, trade_rules
from feedsieve.schemas import trade_schema

from .conftest import AS_OF, NOW

RULES = trade_rules()
TIMES = [dt.datetime(2024, 4, d) for d in (1, 2, 3)]

ROWS = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", "C", "D", "E", None]),
        st.sampled_from([1, 2, 7, None]),
        st.sampled_from(["BUY", "sell", "X", None]),
        st.sampled_from([5, 0, -1, None]),
        st.sampled_from([3, 0, -2, None]),
        st.sampled_from([*TIMES, None]),
    ),
    max_size=25,
)


def expected_reasons(row):
    _, instrument, side, quantity, price, executed = row
    checks = [
        ("instrument_id_present", instrument is None),
        ("price_present", price is None),
        ("quantity_present", quantity is None),
        ("executed_at_present", executed is None),
        ("quantity_positive", quantity is not None and quantity <= 0),
        ("price_positive", price is not None and price <= 0),
        ("side_present", side is None),
        ("side_recognised", side is not None and side.upper() not in ("BUY", "SELL")),
        ("instrument_exists", instrument is not None and instrument not in (1, 2)),
    ]
    return [name for name, failed in checks if failed]


def frame(spark, rows):
    from decimal import Decimal

    full = [
        (t, i, s, None if n is None else Decimal(n), None if p is None else Decimal(p), e, "f", NOW)
        for t, i, s, n, p, e in rows
    ]
    return spark.createDataFrame(full, trade_schema())


LIMITS = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@LIMITS
@given(rows=ROWS)
def test_labels_split_and_counts_agree(spark, instruments, rows):
    df = frame(spark, rows)
    labelled = labels.with_reasons(df, instruments, RULES).collect()
    got = sorted((str(tuple(r)[:6]), r.reasons) for r in labelled)
    plain = [tuple(r)[:6] for r in df.collect()]
    assert got == sorted((str(p), expected_reasons(p)) for p in plain)

    split = labels.batch_split(df, instruments, RULES).first()
    assert split.rows_total == len(rows) == split.rows_valid + split.rows_rejected
    assert split.rows_rejected == sum(bool(expected_reasons(p)) for p in plain)

    counts = q.reason_counts(labels.failing_rows(df, instruments, RULES))
    found = report.rule_report(df, instruments, row_rules(RULES), AS_OF)
    assert all(r.agree for r in report.rule_agreement(found, counts).collect())


@LIMITS
@given(rows=ROWS)
def test_collapse_keeps_the_greatest_row_of_each_key(spark, rows):
    kept = [tuple(r)[:6] for r in collapse_retries(frame(spark, rows)).collect()]
    keyed = [r for r in rows if r[0] is not None]

    def rank(r):
        order = (r[5], r[1], r[2], r[3], r[4])
        return tuple((v is not None, v if v is not None else 0) for v in order)

    best = {}
    for r in keyed:
        if r[0] not in best or rank(r) > rank(best[r[0]]):
            best[r[0]] = r
    assert sorted(map(str, (k for k in kept if k[0] is not None))) == sorted(
        str(tuple(frame_row)) for frame_row in map(_as_stored, best.values())
    )
    assert len(kept) - len(best) == len(rows) - len(keyed)


def _as_stored(r):
    from decimal import Decimal

    t, i, s, n, p, e = r
    quantity = None if n is None else Decimal(n).quantize(Decimal("0.0001"))
    price = None if p is None else Decimal(p).quantize(Decimal("0.000001"))
    return (t, i, s, quantity, price, e)


@LIMITS
@given(first=ROWS, second=ROWS)
def test_quarantine_upsert_converges(spark, instruments, first, second):
    def records(rows, run):
        trades = collapse_retries(frame(spark, rows)).where("trade_id is not null")
        return q.quarantine(trades, instruments, RULES, run, NOW)

    before, again = records(first, "r1"), records(second, "r2")
    once = q.quarantine_upsert(before, again)
    twice = q.quarantine_upsert(once, again)
    got = sorted(map(str, once.collect()))
    assert got == sorted(map(str, twice.collect()))
    merged = {r.trade_id: str(r) for r in before.collect()}
    merged.update({r.trade_id: str(r) for r in again.collect()})
    assert got == sorted(merged.values())
