"""Versioned tables: one rename decides what readers see."""

import datetime as dt
import os

import pytest

from feedsieve.sources import files
from feedsieve.sources.versions import NO_VALUE, Overtaken, VersionedTable, partition_value

DAY = dt.date(2024, 4, 1)


@pytest.fixture()
def store(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T._parse_datatype_string("id long, name string, day date")
    return VersionedTable(spark, str(tmp_path / "t"), schema, "day")


def put(store, *rows, touched=()):
    before, version = store.manifest(), store.begin()
    written = store.write(version, store.spark.createDataFrame(list(rows), store.schema))
    return store.commit(before, version, written, [*touched, *written])


def day(n):
    return DAY + dt.timedelta(n)


def found(rows):
    return sorted(map(tuple, rows.collect()), key=str)


def test_every_version_stays_readable(store):
    assert found(store.rows()) == [] and store.versions() == []
    put(store, (1, "a", day(0)), (2, "b", day(1)), (3, "c", None))
    put(store, (4, "d", day(1)), (5, "e", None), touched=[partition_value(day(0))])
    assert found(store.rows()) == [(4, "d", day(1)), (5, "e", None)]
    assert found(store.rows(1)) == [(1, "a", day(0)), (2, "b", day(1)), (3, "c", None)]
    assert store.manifest().partitions == {"2024-04-02": (2, 1), NO_VALUE: (2, 1)}
    with pytest.raises(ValueError, match="no version 7"):
        store.rows(7)


def test_an_empty_load_is_a_version(store):
    put(store, (1, "a", day(0)))
    put(store)
    assert store.versions() == [1, 2] and found(store.rows()) == [(1, "a", day(0))]


def test_only_one_of_two_writers_commits(store):
    put(store, (1, "a", day(0)))
    before = store.manifest()
    one, rows = store.begin(), store.spark.createDataFrame([(2, "b", day(0))], store.schema)
    written = store.write(one, rows)
    other = store.begin()
    assert other > one
    store.commit(before, other, store.write(other, rows), written)
    with pytest.raises(Overtaken):
        store.commit(before, one, written, written)
    assert store.manifest().version == other


def test_a_manifest_that_is_there_is_not_replaced(spark, tmp_path):
    path = str(tmp_path / "m.json")
    assert files.place_text(spark, path, "one") and not files.place_text(spark, path, "two")
    assert files.read_text(spark, path) == "one"
    assert [n for n in os.listdir(tmp_path) if "draft" in n] == []


def test_forgetting_keeps_what_is_needed(store):
    put(store, (1, "a", day(0)), (2, "b", day(1)))
    put(store, (3, "c", day(1)))
    put(store, (4, "d", day(1)))
    unfinished = store.begin()
    store.write(unfinished, store.spark.createDataFrame([(9, "x", day(5))], store.schema))
    assert store.forget(1) == [1, 2]
    assert store.versions() == [3]
    assert found(store.rows()) == [(1, "a", day(0)), (4, "d", day(1))]
    # The first version's folder still holds a day; that of a load under way is left alone.
    assert sorted(os.listdir(store.data)) == ["v=1", "v=3", f"v={unfinished}"]


def test_partitions_are_pruned_and_others_never_opened(store):
    put(store, (1, "a", day(0)), (2, "b", day(1)))
    folder = f"{store.data}/v=1/day=2024-04-01"
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "wb") as file:
                file.write(b"no parquet")
    assert found(store.rows_of(store.manifest(), ["2024-04-02"])) == [(2, "b", day(1))]
    assert found(store.rows().where("day = DATE '2024-04-02'")) == [(2, "b", day(1))]


def test_counts_and_greatest_come_from_the_manifest_and_the_newest_partition(store):
    assert store.row_count() == 0 and store.greatest("id").first()[0] is None
    put(store, (1, "a", day(0)), (2, "b", day(1)), (3, "c", day(1)), (None, "d", day(2)), (99, "e", None))
    folder = f"{store.data}/v=1/day=2024-04-01"
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "wb") as file:
                file.write(b"no parquet")
    assert store.row_count() == 5
    assert store.greatest("id").first()[0] == 3  # the newest day holds only a null
