import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.operators import load as L
from feedsieve.operators.upsert import upsert
from feedsieve.schemas import trade_schema
from feedsieve.sources.readers import read_feed, read_table

from .conftest import NOW, as_dict, row


def test_empty_text_becomes_null(feed):
    typed = L.typed_feed(feed(row("A", instrument_id="", side="", quantity="", price="", executed_at=""))).first()
    assert (typed.instrument_id, typed.side, typed.quantity, typed.price, typed.executed_at) == (
        None,
    ) * 5


def test_unparseable_text_becomes_null_and_spaces_are_kept(feed):
    typed = L.typed_feed(feed(row("A", instrument_id="1x", side=" BUY", quantity="many", price="1e400", executed_at="2024-13-01"))).first()
    assert typed.side == " BUY"
    assert (typed.instrument_id, typed.quantity, typed.price, typed.executed_at) == (None,) * 4


def test_typed_layout(feed):
    def layout(schema):
        return [(f.name, f.dataType) for f in schema]

    assert layout(L.typed_feed(feed(row("A"))).schema) == layout(trade_schema())
    ntz = T.TimestampNTZType()
    assert layout(L.typed_feed(feed(row("A")), ntz).schema) == layout(trade_schema(ntz))


def test_latest_resend_wins(feed):
    rows = feed(
        row("A", price="1", executed_at="2024-05-01 10:00:00"),
        row("A", price="2", executed_at="2024-05-01 11:00:00"),
        row("A", price="9", executed_at=""),
        row("B", price="3"),
    )
    kept = L.collapse_retries(L.typed_feed(rows))
    assert {k: float(v) for k, v in as_dict(kept, "trade_id", "price").items()} == {
        "A": 2.0,
        "B": 3.0,
    }
    assert kept.columns == trade_schema().fieldNames()


def test_ties_fall_to_the_next_columns_nulls_last(feed):
    rows = feed(
        row("A", instrument_id="", price="7"),
        row("A", instrument_id=2, price=""),
        row("A", instrument_id=2, price="5"),
    )
    kept = L.collapse_retries(L.typed_feed(rows)).collect()
    assert [(r.instrument_id, float(r.price)) for r in kept] == [(2, 5.0)]


def test_rows_without_a_key_are_all_kept(feed):
    rows = feed(row(None, price="1"), row(None, price="1"), row(""), row("A"), row("A"))
    kept = L.collapse_retries(L.typed_feed(rows))
    assert kept.where("trade_id is null").count() == 3
    assert kept.count() == 4


def test_newer_than_keeps_rows_without_a_time(load):
    trades = load(
        row("OLD", executed_at="2024-04-01"),
        row("AT", executed_at="2024-04-02"),
        row("NEW", executed_at="2024-04-03"),
        row("NONE", executed_at=""),
    )
    mark = F.lit(dt.datetime(2024, 4, 2))
    assert {r.trade_id for r in L.newer_than(trades, mark).collect()} == {"AT", "NEW", "NONE"}
    assert L.newer_than(trades, None).count() == 4


def test_incremental_load_skips_what_is_loaded(spark, load, feed):
    existing = load(row("A", price="1", executed_at="2024-04-01"), row("Z", executed_at="2024-04-02"))
    batch = feed(
        row("A", price="2", executed_at="2024-04-01"),
        row("AT", executed_at="2024-04-02"),
        row("B", executed_at="2024-04-03"),
        row("C", executed_at=""),
    )
    marks = L.source_watermarks(existing)
    for after in (
        L.load_trades(existing, batch, incremental=True),
        L.load_trades(existing, batch, incremental=True, marks=marks),
    ):
        prices = as_dict(after, "trade_id", "price")
        assert set(prices) == {"A", "Z", "AT", "B", "C"}
        assert float(prices["A"]) == 1.0
    late = L.late_rows(L.typed_feed(batch), L.high_watermark(marks, "high_watermark").scalar())
    assert as_dict(late, "source_file", "late_rows") == {"feed.csv": 1}
    whole = L.load_trades(existing, batch)
    assert float(as_dict(whole, "trade_id", "price")["A"]) == 2.0


def test_every_row_of_a_load_is_accounted_for(load, feed):
    existing = load(row("A"), row("B"))
    batch = feed(row("A", price="3"), row("A"), row("C"), row(None), row("", price="4"))
    found = L.load_balance(existing, batch).first().asDict()
    assert found == {
        "rows_in": 5,
        "rows_upserted": 2,
        "rows_superseded": 1,
        "rows_unkeyed": 2,
        "rows_new": 1,
    }
    once = L.load_trades(existing, batch)
    assert once.where("trade_id IS NULL").count() == 2
    again = L.load_trades(once, batch)
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))


def test_incremental_load_into_an_empty_table(spark, feed):
    empty = spark.createDataFrame([], trade_schema())
    assert L.load_trades(empty, feed(row("A"), row("B", executed_at=""))).count() == 2


def test_reloading_a_snapshot_is_harmless(load, feed):
    existing = load(row("A"), row("B", price=""))
    again = L.load_trades(existing, feed(row("A"), row("B", price="")), incremental=False)
    assert sorted(map(str, again.collect())) == sorted(map(str, existing.collect()))


def test_upsert_replaces_adds_and_keeps_rows_without_a_key(spark):
    schema = "k string, v int"
    old = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    new = spark.createDataFrame([("b", 3), ("c", 4), (None, 5)], schema)
    after = upsert(old, new, ["k"])
    assert as_dict(after, "k", "v") == {"a": 1, "b": 3, "c": 4, None: 5}
    assert upsert(after, new, ["k"]).count() == 4


def test_equal_rows_without_a_key_all_stay(spark, feed):
    empty = spark.createDataFrame([], trade_schema())
    batch = feed(row("A"), row(None), row(""), row("", price="11"))
    balance = L.load_balance(empty, batch).first()
    once = L.load_trades(empty, batch, incremental=False)
    assert once.where("trade_id IS NULL").count() == balance.rows_unkeyed == 3
    again = L.load_trades(once, batch, incremental=False)
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))
    more = L.load_trades(once, feed(row(""), row(""), row("")), incremental=False)
    assert more.where("trade_id IS NULL").count() == 4


def test_watermarks_never_move_back(load):
    first = load(row("A", executed_at="2024-04-05"), source="x.csv")
    marks = L.source_watermarks(first)
    older = load(row("B", executed_at="2024-04-01"), source="x.csv")
    other = load(row("C", executed_at="2024-04-02"), source="y.csv")
    after = as_dict(
        L.advance_watermarks(L.advance_watermarks(marks, older), other),
        "source_file",
        "high_watermark",
    )
    assert after == {"x.csv": dt.datetime(2024, 4, 5), "y.csv": dt.datetime(2024, 4, 2)}


def test_feed_files_carry_their_name(spark, tmp_path):
    (tmp_path / "day1.csv").write_text(
        "trade_id,instrument_id,side,quantity,price,executed_at\n"
        "A,1,BUY,5,10.5,2024-05-01T10:00:00\nB,,,,,\n"
    )
    typed = L.typed_feed(read_feed(spark, str(tmp_path), ingested_at=NOW)).orderBy("trade_id")
    first, second = typed.collect()
    assert (first.source_file, first.ingested_at) == ("day1.csv", NOW)
    assert first.executed_at == dt.datetime(2024, 5, 1, 10)
    assert (second.trade_id, second.side, second.price) == ("B", None, None)


def test_read_table_formats(spark, load, tmp_path):
    trades = load(row("A"))
    for fmt in ("parquet", "orc", "json"):
        path = str(tmp_path / fmt)
        trades.write.format(fmt).save(path)
        back = read_table(spark, path, fmt, schema=trade_schema())
        assert back.first().trade_id == "A"
    trades.createOrReplaceTempView("some_trades")
    assert read_table(spark, "some_trades", "table").count() == 1
