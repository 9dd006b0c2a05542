"""The key index: bucket joins, filters, unfinished loads."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedsieve.sources.key_index import KeyIndex, duplicates_after


@pytest.fixture()
def index(spark, tmp_path):
    return KeyIndex(spark, str(tmp_path / "keys"), expected_keys=2_000, buckets=4)


def keyed(spark, keys):
    return spark.createDataFrame([(k, "2024-04-01") for k in keys], "trade_id string, day string")


def loads(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "load long")


def test_duplicates_equal_counting_everything(spark, index):
    rng = random.Random(3)
    first = [rng.choice([None, "hot", f"T{rng.randint(0, 400)}"]) for _ in range(900)]
    second = [rng.choice([None, "hot", "", f"T{rng.randint(300, 700)}"]) for _ in range(300)]
    index.add(keyed(spark, first), F.col("day"), 1)
    found = duplicates_after(index, keyed(spark, second), loads(spark, 1)).collect()
    before, after = Counter(first), Counter(first + second)
    expected = {k: (before[k], after[k]) for k in set(second) - {None} if after[k] > 1}
    assert {r.trade_id: (r.before, r.n) for r in found} == expected


def test_known_keys_pass_the_filters_and_most_others_do_not(spark, index):
    index.add(keyed(spark, [f"A{i}" for i in range(1000)]), F.col("day"), 1)
    index.add(keyed(spark, [f"B{i}" for i in range(1000)]), F.col("day"), 2)
    asked = [f"{kind}{i}" for kind in "ABC" for i in range(1000)]
    passed = Counter(r.trade_id[0] for r in index.maybe_known(keyed(spark, asked)).collect())
    assert passed["A"] == passed["B"] == 1000
    assert passed["C"] < 100


def test_the_newest_finished_load_tells_the_place(spark, index):
    rows = keyed(spark, ["A", "B", "C"])
    for load, place in ((1, "x"), (2, "y"), (3, "z")):
        index.add(rows if load < 3 else rows.where("trade_id = 'A'"), F.lit(place), load)
    # Load 2 was never finished.
    found = index.newest(keyed(spark, ["A", "B", "N", None]), loads(spark, 1, 3)).collect()
    assert {r.trade_id: r.place for r in found} == {"A": "z", "B": "x"}


def test_an_empty_index_knows_nothing(spark, index):
    assert index.newest(keyed(spark, ["A"]), loads(spark)).collect() == []
    assert duplicates_after(index, keyed(spark, ["A", "A"]), loads(spark)).collect()[0].n == 2


def test_sizes_are_those_the_index_was_made_with(spark, index):
    index.add(keyed(spark, [f"A{i}" for i in range(50)]), F.col("day"), 1)
    again = KeyIndex(spark, index.path, expected_keys=50_000_000)
    assert again.counts(keyed(spark, ["A7", "Z"]), loads(spark, 1)).collect()[0].n == 1
    assert (again.buckets, again.words) == (index.buckets, index.words)


def test_index_rows_are_not_moved(spark, index):
    index.add(keyed(spark, [f"A{i}" for i in range(50)]), F.col("day"), 1)
    entries = index.entries(keyed(spark, ["A1"]), loads(spark, 1))
    for df in (entries, index.counts(keyed(spark, ["A1"]), loads(spark, 1))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "Bucketed: true" in line)
        above = plan[: plan.index(scan)].splitlines()
        depth = scan.index("FileScan")
        # Nothing that encloses the scan exchanges rows: only its sibling, the keys, does.
        enclosing = []
        for line in reversed(above):
            indent = len(line) - len(line.lstrip(" :+-*"))
            if indent < depth:
                enclosing.append(line)
                depth = indent
        assert enclosing and not any("Exchange hashpartitioning" in line for line in enclosing), plan
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
