import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from feedsieve.operators import labels, pnl
from feedsieve.rules import trade_rules

from .conftest import row

RULES = trade_rules()
DAY1, DAY2, DAY3 = dt.date(2024, 5, 1), dt.date(2024, 5, 2), dt.date(2024, 5, 3)


def trades_of(load):
    return load(
        row("A", side="BUY", quantity=10, price="5", executed_at="2024-05-01 09:00:00"),
        row("B", side="sell", quantity=4, price="6", executed_at="2024-05-01 15:00:00"),
        row("C", side="BUY", quantity=1, price="7", executed_at="2024-05-03 09:00:00"),
        row("D", instrument_id=2, quantity=2, price="100", executed_at="2024-05-01 09:00:00"),
    )


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_daily_figures(load):
    rows = by_key(pnl.daily_pnl(trades_of(load)), "trade_date", "instrument_id")
    assert set(rows) == {(DAY1, 1), (DAY3, 1), (DAY1, 2)}
    first = rows[DAY1, 1]
    assert (first.trades, first.buy_qty, first.sell_qty, first.net_qty) == (2, 10, 4, 6)
    assert (first.gross_notional, first.net_cash, first.close_price) == (74, -26, 6)
    assert first.pnl == 10  # 6 held at 6, 26 paid


def test_close_of_simultaneous_trades_is_the_highest_id(load):
    same = "2024-05-01 09:00:00"
    trades = load(
        row("T2", price="5", executed_at=same),
        row("T9", price="6", executed_at=same),
        row("T1", price="7", executed_at=same),
    )
    assert pnl.daily_pnl(trades).first().close_price == 6


def test_fractions_are_exact(load):
    trades = load(row("A", quantity="0.0001", price="0.000001"), row("B", side="SELL", quantity=100, price="3"))
    day = pnl.daily_pnl(trades).first()
    assert day.net_cash == D("299.9999999999")
    assert day.gross_notional == D("300.0000000001")


def test_by_asset_class_joins_known_instruments_once(load, instruments):
    doubled = instruments.unionByName(instruments)
    rows = by_key(
        pnl.daily_pnl_by(trades_of(load), doubled), "trade_date", "asset_class"
    )
    assert set(rows) == {(DAY1, "EQUITY"), (DAY3, "EQUITY"), (DAY1, "BOND")}
    assert (rows[DAY1, "EQUITY"].trades, rows[DAY1, "EQUITY"].net_qty) == (2, 6)
    assert rows[DAY1, "BOND"].net_cash == -200


def test_running_position(load):
    days = pnl.daily_position(pnl.daily_pnl(trades_of(load)))
    rows = by_key(days, "trade_date", "instrument_id")
    last = rows[DAY3, 1]
    assert (last.position, last.cash, last.previous_close) == (7, -33, 6)
    assert (last.market_value, last.total_pnl) == (49, 16)
    assert rows[DAY1, 1].previous_close is None


def test_gap_shows_what_was_left_out(load, instruments):
    trades = load(
        row("A"),
        row("B", price=""),
        row("C", price="", side=""),
        row("N", executed_at=""),
        row("O", instrument_id=9, executed_at="2024-05-02"),
        row("G", instrument_id=2),
    )
    rows = by_key(
        pnl.coverage_gap(trades, instruments, RULES), "trade_date", "instrument_id", "reason"
    )
    assert rows[DAY1, 1, "price_present"].reason_rows == 2
    assert rows[DAY1, 1, "side_present"].reason_rows == 1
    assert (rows[DAY1, 1, "side_present"].trades, rows[DAY1, 1, "side_present"].rows_rejected) == (
        1,
        2,
    )
    assert rows[None, 1, "executed_at_present"].trades == 0
    assert rows[DAY2, 9, "instrument_exists"].rows_rejected == 1
    assert rows[DAY1, 2, None].reason_rows is None
    assert len(rows) == 5


def test_gap_trades_equal_daily_trades(load, instruments):
    trades = load(row("A"), row("B", price=""), row("C", instrument_id=2), row("D", side="X"))
    daily = by_key(
        pnl.daily_pnl(labels.valid_rows(trades, instruments, RULES)),
        "trade_date",
        "instrument_id",
    )
    gap = by_key(
        pnl.coverage_gap(trades, instruments, RULES), "trade_date", "instrument_id"
    )
    for key, day in daily.items():
        assert (gap[key].trades, gap[key].gross_notional) == (day.trades, day.gross_notional)


def positions_of(load, *rows):
    return pnl.daily_position(pnl.daily_pnl(load(*rows)))


def test_an_instrument_is_marked_on_every_day_of_its_life(load):
    positions = positions_of(
        load,
        row("A", quantity=10, price="5", executed_at="2024-05-01"),
        row("B", side="SELL", quantity=4, price="6", executed_at="2024-05-04"),
        row("C", instrument_id=2, quantity=1, price="9", executed_at="2024-05-02"),
    )
    marked = by_key(pnl.marked_daily(positions), "day", "instrument_id")
    assert {k[0].day for k in marked if k[1] == 1} == {1, 2, 3, 4}
    assert {k[0].day for k in marked if k[1] == 2} == {2}
    third = marked[DAY3, 1]
    assert (third.position, third.close_price, third.market_value, third.days_since_trade) == (10, 5, 50, 2)
    book = by_key(pnl.daily_book(pnl.marked_daily(positions)), "day")
    second = book[(DAY2,)]
    assert (second.instruments, second.marked_at_older_close, second.market_value) == (2, 1, 59)
    assert pnl.marked_daily(positions.limit(0)).collect() == []


def test_positions_resumed_from_carries_equal_the_full_window(load):
    rows = [
        row(f"T{i}", instrument_id=1 + i % 3, side="SELL" if i % 4 == 0 else "BUY", quantity=i + 1,
            price=f"{10 + i}.25", executed_at=f"2024-{1 + i // 5:02d}-{1 + i % 5:02d}")
        for i in range(25)
    ]
    rows.append(row("OLD", instrument_id=9, executed_at="2024-01-02"))  # never traded again
    rows.append(row("NEW", instrument_id=8, executed_at="2024-05-02"))
    daily = pnl.daily_pnl(load(*rows))
    whole = pnl.daily_position(daily).withColumn("month", F.trunc("trade_date", "month"))
    carries = pnl.position_carry(whole, "month")
    for since in ("2024-01-01", "2024-03-01", "2024-05-01", "2025-01-01"):
        resumed = pnl.resumed_position(
            daily.where(F.col("trade_date") >= since), carries.where(F.col("month") < since), "month"
        )
        expected = whole.drop("month").where(F.col("trade_date") >= since)
        assert sorted(map(str, resumed.collect())) == sorted(map(str, expected.collect()))


def test_instruments_marked_together_make_the_same_book(load):
    lines = [
        row(f"T{i}-{day}", instrument_id=i, quantity=i, price=f"{i}.{day}1", executed_at=f"2024-05-0{day}")
        for i in range(1, 31)
        for day in ((1, 4) if i % 2 else (2, 4, 5))
    ]
    positions = positions_of(load, *lines)
    together = pnl.marked_daily(positions, together=True)
    # Two ways to stand from day to day, not thirty.
    assert together.count() == 3 + 2 + 1 + 1
    book = pnl.daily_book(pnl.marked_daily(positions))
    assert book.count() == 5
    assert sorted(map(str, pnl.daily_book(together).collect())) == sorted(map(str, book.collect()))
    assert pnl.marked_daily(positions.limit(0), together=True).collect() == []
