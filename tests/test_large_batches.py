"""Queries on hand-made lines as if a batch had too many keys to broadcast."""

import datetime as dt

import pytest

from feedsieve.plans import queries

START = dt.datetime(1998, 11, 1)


@pytest.fixture()
def lines(spark, tmp_path):
    """A folder with ``lineitem`` and ``part``: trades before and after the second batch begins, some re-sent."""
    rows = [
        (1 + i % 40, 3 + i % 7, 5, 1 + i % 3, 4.0 + i % 5, 100.0 + i, "R" if i % 4 == 0 else "N", "F" if i % 2 else "O",
         START + dt.timedelta(3 * i))
        for i in range(60)
    ]
    spark.createDataFrame(
        rows,
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = [(i, f"part {i}", "TYPE") for i in range(1, 20)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("few", [True, False])
def test_a_load_broadcasts_keys_only_if_they_were_measured_as_few(spark, lines, monkeypatch, few):
    told, plain = [], queries.upsert.upsert
    expected = sorted(map(str, queries.loaded_as_of(spark, lines).collect()))
    monkeypatch.setattr(queries, "small_enough", lambda keys: few)
    monkeypatch.setattr(queries.upsert, "upsert", lambda a, b, keys, few=False: told.append(few) or plain(a, b, keys, few))
    found = queries.loaded_as_of(spark, lines).collect()
    assert told == [few]
    assert sorted(map(str, found)) == expected
    assert {r.version for r in found} == {1, 2}


def plan_of(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_positions_are_refreshed_from_batches_merged_once(spark, lines, monkeypatch):
    given, plain = [], queries.pnl.touched_days
    monkeypatch.setattr(queries.pnl, "touched_days", lambda *tables: given.extend(tables) or plain(*tables))
    assert queries.position_refresh(spark, lines).count() > 0
    assert len(given) == 2
    assert not [t for t in given if "Aggregate" in plan_of(t) or "Join" in plan_of(t)]


def test_touched_days_are_found_without_moving_rows(spark):
    layout = "trade_id string, executed_at timestamp_ntz, `unit price` long, other long"
    first, second, third = (START + dt.timedelta(i, 3600) for i in range(3))
    same = [("A", first, 1, 1), (None, first, 2, 2), (None, first, 2, 2), ("Z", None, 5, 5)]
    before = [*same, ("B", second, 7, None), ("C", third, 1, 1), ("C", third, 1, 1)]
    after = [*reversed(same), ("B", second, None, 7), ("C", third, 1, 1), ("D", None, 1, 1)]
    days = queries.pnl.touched_days(*(spark.createDataFrame(rows, layout) for rows in (before, after)))
    found = {r.trade_date for r in days.collect()}
    assert found == {second.date(), third.date(), None}
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(trade_date" in plan and "trade_id" not in plan.split("Union")[0]


def test_routes_merge_the_trades_once(spark, lines, monkeypatch):
    plans, plain = {}, queries._written
    monkeypatch.setattr(queries, "_written", lambda s, rows, name: plans.setdefault(name, plan_of(rows)) and plain(s, rows, name))
    assert queries.quality_routes(spark, lines).count() == 6
    assert {name: "Aggregate [trade_id" in plan for name, plan in plans.items()} == {"trades": True, "sound": False}


def test_a_refresh_stores_only_what_daily_figures_need(spark, lines, monkeypatch):
    stored, plain = {}, queries._written
    monkeypatch.setattr(queries, "_written", lambda s, rows, name: stored.setdefault(name, rows.columns) and plain(s, rows, name))
    given, replaced = [], queries.pnl.replace_days
    monkeypatch.setattr(queries.pnl, "replace_days", lambda a, b, days: given.append(plan_of(days)) or replaced(a, b, days))
    assert queries.daily_refresh(spark, lines).count() > 0
    needed = ["trade_id", "instrument_id", "side", "quantity", "price", "executed_at"]
    assert stored == {"first": needed, "second": needed, "loaded": needed, "days": ["trade_date"]}
    assert "Join" not in given[0]  # the touched days are found once
