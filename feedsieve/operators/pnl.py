"""Daily aggregates of valid trades.

Direction comes from ``side``, position from ``quantity``, value from ``price``.
All sums combine on the map side, so an instrument holding a third of the
trades costs one partial row per task and day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedsieve.functions.predicates import literal, quoted
from feedsieve.operators.labels import References, any_failure, rule_flags
from feedsieve.operators.references import small_enough
from feedsieve.rules import Rule
from feedsieve.schemas import MONEY_TYPE

POSITION_TYPE = "decimal(28,4)"


def trade_date() -> Column:
    return F.col("executed_at").cast("date")


def _flows(valid: str | None = None) -> list[Column]:
    """Sums of the trading day, over the rows where the SQL flag ``valid`` holds."""
    notional = f"CAST(quantity * price AS {MONEY_TYPE.simpleString()})"
    cash = f"IF(upper(side) = 'BUY', -{notional}, {notional})"

    def total(value: str, wanted: str, kind: str, name: str) -> str:
        kept = f"({wanted})" if valid is None else f"({wanted}) AND ({valid})"
        return f"CAST(coalesce(sum(CASE WHEN {kept} THEN {value} END), 0) AS {kind}) AS {name}"

    money = MONEY_TYPE.simpleString()
    sums = [
        "count(1) AS trades" if valid is None else f"count_if({valid}) AS trades",
        total("quantity", "upper(side) = 'BUY'", POSITION_TYPE, "buy_qty"),
        total("quantity", "upper(side) = 'SELL'", POSITION_TYPE, "sell_qty"),
        total(notional, "true", money, "gross_notional"),
        total(cash, "true", money, "net_cash"),
    ]
    return [F.expr(s) for s in sums]


def _net_qty() -> Column:
    return (F.col("buy_qty") - F.col("sell_qty")).cast(POSITION_TYPE)


def daily_pnl(trades: DataFrame, valid: str | None = None) -> DataFrame:
    """One row per day and instrument, from valid trades.

    The close is the price of the last trade; ``pnl`` is the cash of the day
    plus the position of the day valued at the close. With the SQL flag
    ``valid`` the input may hold other rows too; a group without a valid one then has no trades.
    """
    last = "struct(executed_at, trade_id, price)"
    if valid is not None:
        last = f"CASE WHEN {valid} THEN {last} END"
    return (
        trades.groupBy(trade_date().alias("trade_date"), "instrument_id")
        .agg(
            *_flows(valid),
            F.expr(f"max({last}) AS last"),
        )
        .select(
            "trade_date",
            "instrument_id",
            "trades",
            "buy_qty",
            "sell_qty",
            _net_qty().alias("net_qty"),
            "gross_notional",
            "net_cash",
            F.col("last.price").alias("close_price"),
        )
        .withColumn("pnl", _marked("net_qty", "close_price") + _addend("net_cash"))
    )


def touched_days(before: DataFrame, after: DataFrame) -> DataFrame:
    """Days whose trades differ between two versions of the trade table.

    A trade moved to another day, or left without one, touches the day it left as well.

    The rows of a day are summed up by their number and by two 64-bit hashes of every column, which combine on the
    map side: no row is moved. A day that differs would be missed only if its rows collide in both hashes.
    """
    # A null leaves a hash as it was, so what is null is hashed too.
    told = [e for c in after.columns for e in (F.col(quoted(c)), F.col(quoted(c)).isNull())]
    hashes = F.xxhash64(*told), F.xxhash64(F.lit("again"), *told)
    # Halves of 32 bits, so that sums do not overflow.
    halves = [half for h in hashes for half in (F.shiftright(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    names = [f"_s{i}" for i in range(len(halves) + 1)]

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        marks = [(F.lit(sign) * part).cast("long").alias(n) for n, part in zip(names, (F.lit(1), *halves), strict=True)]
        return rows.select(trade_date().alias("trade_date"), *marks)

    both = signed(before.select(*[quoted(c) for c in after.columns]), -1).unionByName(signed(after, 1))
    changed = " OR ".join(f"{n} <> 0" for n in names)
    return both.groupBy("trade_date").agg(*[F.sum(n).alias(n) for n in names]).where(changed).select("trade_date")


def days_of_batch(before: DataFrame, batch: DataFrame, key: str = "trade_id") -> DataFrame:
    """Days an upsert of ``batch`` touches: those of its rows and those of the versions it replaces.

    Only days whose trades may differ; the table is read once and not compared with itself. The batch's keys
    are measured before they are broadcast.
    """
    keys = batch.where(F.col(key).isNotNull()).select(key)
    if small_enough(keys):
        keys = F.broadcast(keys)
    replaced = before.join(keys, key, "left_semi")
    both = batch.select(trade_date().alias("trade_date")).unionByName(
        replaced.select(trade_date().alias("trade_date"))
    )
    return both.distinct()


def replace_days(stored: DataFrame, fresh: DataFrame, days: DataFrame) -> DataFrame:
    """Daily rows with those of the given days replaced; a day may be left empty."""
    gone = days.select(F.col("trade_date").alias("_day"))
    kept = stored.join(gone, F.col("trade_date").eqNullSafe(F.col("_day")), "left_anti")
    return kept.unionByName(fresh)


def _marked(quantity: str, price: str) -> Column:
    """Value of a quantity at a price, narrow enough to be added without rounding."""
    return (F.col(quantity).cast("decimal(18,4)") * F.col(price)).cast("decimal(37,10)")


def _addend(name: str) -> Column:
    return F.col(name).cast("decimal(37,10)")


def daily_pnl_by(
    trades: DataFrame, instruments: DataFrame, attribute: str = "asset_class"
) -> DataFrame:
    """One row per day and instrument attribute.

    Trades are summed per day and instrument first, so the join with the
    reference data sees one row for a hot instrument and day.
    """
    daily = trades.groupBy(trade_date().alias("trade_date"), "instrument_id").agg(*_flows())
    lookup = instruments.where("instrument_id is not null").groupBy("instrument_id").agg(
        F.min(attribute).alias(attribute)
    )
    if small_enough(instruments.select("instrument_id", attribute)):
        lookup = F.broadcast(lookup)
    summed = (
        daily.join(lookup, "instrument_id")
        .groupBy("trade_date", attribute)
        .agg(
            F.sum("trades").alias("trades"),
            *[F.sum(c).cast(POSITION_TYPE).alias(c) for c in ("buy_qty", "sell_qty")],
            *[F.sum(c).cast(MONEY_TYPE).alias(c) for c in ("gross_notional", "net_cash")],
        )
    )
    return summed.withColumn("net_qty", _net_qty())


def daily_position(daily: DataFrame) -> DataFrame:
    """Running position per instrument, valued at each day's close.

    The window runs over ``daily_pnl`` rows: an instrument has at most one per
    day, so no group grows with the trades.
    """
    days = Window.partitionBy("instrument_id").orderBy("trade_date")
    so_far = days.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = daily.select(
        "trade_date",
        "instrument_id",
        "close_price",
        F.sum("net_qty").over(so_far).cast(POSITION_TYPE).alias("position"),
        F.sum("net_cash").over(so_far).cast(MONEY_TYPE).alias("cash"),
        F.lag("close_price").over(days).alias("previous_close"),
    )
    return running.withColumn("market_value", _marked("position", "close_price")).withColumn(
        "total_pnl", F.col("market_value") + _addend("cash")
    )


def position_carry(positions: DataFrame, period: str) -> DataFrame:
    """What each instrument carries out of each period (a column of ``positions``) in which it traded."""
    last = F.max(F.struct("trade_date", "position", "cash", "close_price")).alias("_last")
    return (
        positions.groupBy(period, "instrument_id")
        .agg(last)
        .select(
            period,
            "instrument_id",
            F.col("_last.position").alias("position"),
            F.col("_last.cash").alias("cash"),
            F.col("_last.close_price").alias("close_price"),
        )
    )


def resumed_position(daily: DataFrame, carries: DataFrame, period: str) -> DataFrame:
    """``daily_position`` of the days in ``daily``, taken up from the carries of earlier periods.

    ``daily`` holds every day from some period on, ``carries`` those of the periods before it. The running sums
    start from each instrument's latest carry, so no earlier day is read. The carry joins as one more
    day of its instrument, in front of the others.
    """
    latest = carries.groupBy("instrument_id").agg(
        F.max_by(F.struct("position", "cash", "close_price"), period).alias("_c")
    )
    columns = ["trade_date", "instrument_id", "close_price", "net_qty", "net_cash"]
    carried = latest.select(
        F.lit(None).cast("date").alias("trade_date"),  # nulls come first
        "instrument_id",
        F.col("_c.close_price").alias("close_price"),
        F.col("_c.position").alias("net_qty"),
        F.col("_c.cash").alias("net_cash"),
    )
    dated = daily.where(F.col("trade_date").isNotNull()).select(*columns)
    return daily_position(dated.unionByName(carried)).where(F.col("trade_date").isNotNull())


def marked_daily(positions: DataFrame, together: bool = False) -> DataFrame:
    """A row per instrument and calendar day of its life, valued at its last close.

    Each row of ``daily_position`` stands until the day before the instrument's next one, so the days in between are
    made by expanding that interval: no calendar is joined and nothing outside an instrument's first and last day is made.
    ``days_since_trade`` tells how old the close is.

    With ``together`` the instruments that stand at the same close day until the same day are marked as one row, with
    their number (``instruments``) and value: so many rows as pairs of days have, however many instruments there are.
    """
    days = Window.partitionBy("instrument_id").orderBy("trade_date")
    upto = F.coalesce(F.date_sub(F.lead("trade_date").over(days), 1), F.col("trade_date"))
    held = positions.where(F.col("trade_date").isNotNull()).withColumn("_upto", upto)
    columns = ["instrument_id", "position", "close_price", "market_value", "cash"]
    if together:
        held = held.groupBy("trade_date", "_upto").agg(
            F.count(F.lit(1)).alias("instruments"), F.sum("market_value").alias("market_value")
        )
        columns = ["instruments", "market_value"]
    return held.select(
        F.explode(F.sequence("trade_date", "_upto")).alias("day"), *columns, "trade_date"
    ).select("day", *columns, F.date_diff("day", "trade_date").alias("days_since_trade"))


def daily_book(marked: DataFrame) -> DataFrame:
    """All instruments of a day together: how many are held, how many at an older close, and their value."""
    held = F.col("instruments") if "instruments" in marked.columns else F.lit(1).cast("long")
    older = F.when(F.col("days_since_trade") > 0, held).otherwise(F.lit(0).cast("long"))
    return marked.groupBy("day").agg(
        F.sum(held).alias("instruments"),
        F.sum(older).alias("marked_at_older_close"),
        F.sum("market_value").cast(MONEY_TYPE).alias("market_value"),
        F.max("days_since_trade").alias("oldest_close_days"),
    )


def coverage_gap(
    trades: DataFrame, references: References | None, rules: Sequence[Rule]
) -> DataFrame:
    """What was excluded beside what was aggregated, per day and instrument.

    Days and instruments can be null here: that is where such rows went. One
    aggregation over the labelled rows gives both sides, so no join is needed.
    Long format: a group without rejects has one row with a null reason.
    """
    marked, flags = rule_flags(trades, references, rules)
    broken = any_failure(flags)
    counted = marked.groupBy(trade_date().alias("trade_date"), "instrument_id").agg(
        *_flows(f"NOT {broken}"),
        F.expr(f"count_if({broken}) AS rows_rejected"),
        *[F.expr(f"count_if({flag}) AS {quoted('n_' + n)}") for n, flag in flags.items()],
    )
    listed = ", ".join(f"struct({literal(n)} AS reason, {quoted('n_' + n)} AS n)" for n in flags)
    counts = f"CAST(array({listed}) AS ARRAY<STRUCT<reason: STRING, n: BIGINT>>)"
    return counted.selectExpr(
        "trade_date",
        "instrument_id",
        "trades",
        "gross_notional",
        "rows_rejected",
        f"explode_outer(filter({counts}, c -> c.n > 0)) AS gap",
    ).selectExpr("* EXCEPT (gap)", "gap.reason AS reason", "gap.n AS reason_rows")
