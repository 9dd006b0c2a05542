import datetime as dt

from feedsieve.operators.load import collapse_retries, typed_feed
from feedsieve.schemas import FEED_SCHEMA
from feedsieve.sources.readers import stream_feed
from feedsieve.sources.tables import QualityTables
from feedsieve.sources.trades import TradeTable
from feedsieve.streaming.feed_stream import check_arrivals, load_settled

from .conftest import AS_OF, NOW, row

HEADER = "trade_id,instrument_id,side,quantity,price,executed_at\n"


def test_each_file_is_checked_once(spark, instruments, tmp_path):
    arrivals = tmp_path / "in"
    arrivals.mkdir()
    tables = QualityTables(spark, str(tmp_path / "quality"))
    tables.ensure()

    def check():
        query = check_arrivals(
            stream_feed(spark, str(arrivals)),
            instruments,
            tables,
            str(tmp_path / "checkpoint"),
            as_of=AS_OF,
        )
        query.awaitTermination(120)

    (arrivals / "a.csv").write_text(
        HEADER + "A,1,BUY,5,10,2024-05-01T10:00:00\nB,1,BUY,5,,2024-05-01T10:00:00\n"
    )
    check()
    (arrivals / "b.csv").write_text(
        HEADER + "B,1,BUY,5,10,2024-05-01T11:00:00\nC,9,X,5,10,2024-05-01T12:00:00\n"
    )
    check()
    check()
    runs = {r.run_id: (r.rows_checked, r.rows_rejected) for r in tables.runs().collect()}
    assert runs == {"feed-0": (2, 1), "feed-1": (2, 1)}
    current = {r.trade_id: r.reasons for r in tables.current_rejected().collect()}
    assert current == {"B": ["price_present"], "C": ["side_recognised", "instrument_exists"]}
    assert {r.source_file for r in tables.watermarks().collect()} == {"a.csv", "b.csv"}


def test_a_resend_in_a_later_batch_is_merged_as_in_one_batch(spark, tmp_path):
    """State survives from call to call: the stream ends with what one batch of all rows gives."""
    layout = f"{', '.join(f'{n} string' for n in FEED_SCHEMA.fieldNames())}, source_file string, ingested_at timestamp"
    arrivals, table = tmp_path / "in", TradeTable(spark, str(tmp_path / "lake"))
    arrivals.mkdir()

    def arrive(name, *lines):
        """Lines with the hours after NOW at which they arrive."""
        rows = [{**line, "source_file": name, "ingested_at": NOW + dt.timedelta(hours=h)} for h, line in lines]
        spark.createDataFrame(rows, layout).coalesce(1).write.mode("append").json(str(arrivals))
        stream = spark.readStream.schema(layout).json(str(arrivals))
        query = load_settled(stream, table, str(tmp_path / "checkpoint"), "2 hours")
        query.awaitTermination(120)
        assert query.exception() is None

    newer, older = "2024-05-01 12:00:00", "2024-05-01 10:00:00"
    arrive("a", (0, row("A", executed_at=newer, price="1")), (0, row("B")), (0, row("")))
    # The older version of A arrives later and must not win.
    arrive("b", (1, row("A", executed_at=older, price="2")), (1, row("B", quantity=9)))
    assert table.rows().where("trade_id = 'A'").count() == 0  # not settled yet
    arrive("c", (9, row("C")))
    arrive("d", (30, row("Z")))
    arrive("e", (60, row("Z2")))
    stored = table.rows().where("trade_id IS NULL OR trade_id NOT LIKE 'Z%'")
    whole = spark.read.schema(layout).json(str(arrivals))
    expected = collapse_retries(typed_feed(whole)).where("trade_id IS NULL OR trade_id NOT LIKE 'Z%'")
    assert sorted(map(str, stored.collect())) == sorted(map(str, expected.collect()))
    assert {r.trade_id: str(r.price) for r in stored.collect()}["A"] == "1.000000"
