"""Every query and the pipeline over tables that are unlike the given ones, and texts read in parts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from feedsieve.llm import queries, shingles, suffix_dedup

# Columns called like what the operators add or use inside.
CLASHING = (
    "kept n_bytes n_removed n_spans id th raw gram seg at copies large spans starts ends asked h body sha digest n vec keys "
    "own own_sha a b key head m __bucket __own __copy __lang __id __h __kept bucket shard slot sequence_id offset piece start "
    "length score label held_out nearest rejected block part place pairs which digit bits word phrase f w1 plain ids"
).split()


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Two folders of tables: odd rows, and none."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)] + ["the", "of"]
    texts = [" ".join(rng.choices(words, k=rng.choice([3, 40, 120]))) + "." for _ in range(60)]
    texts += [texts[0]] * 3 + [texts[1] + " end", "", None, " ", "é日本 🙂", "x" * 3000]
    rows = [(i, t, rng.choice(["en", "de", None]), f"src{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, texts[2], "en", None, None), (None, None, None, None, None), (5, texts[5], "en", "s", 1), (5, "other", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    docs = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHING)))
    labels = [(i, 1, int(i % 9 == 0)) for i in range(50)] + [(None, 1, 1), (3, None, None), (5, 0, 0)]
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"t{t}{c if t > 1 else ''}") for c in range(6) for t in range(4)]
    vectors = [(i, [rng.random() for _ in range(4)]) for i in range(120)] + [(None, [0.5] * 4), (100, None)]
    tables = {
        "documents": docs,
        "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        "conversations": spark.createDataFrame(turns + turns[:3] + [(None, None, None, None)], "conv_id long, turn long, role string, text string"),
        "embeddings": spark.createDataFrame(vectors, "vec_id long, embedding array<float>"),
    }
    root = tmp_path_factory.mktemp("odd")
    for name, rows in tables.items():
        rows.coalesce(2).write.parquet(str(root / "odd" / f"{name}.parquet"))
        rows.limit(0).coalesce(1).write.parquet(str(root / "empty" / f"{name}.parquet"))
    return str(root / "odd"), str(root / "empty"), docs.count()


PER_DOCUMENT = ("op1_", "op3_", "op4_", "op6_", "op7_", "op8_", "op10_", "op11_", "op13_")


@pytest.mark.parametrize("name", [*queries.queries(), "pipeline"])
def test_clashing_names_missing_ids_repeated_rows_and_empty_tables(spark, folders, name):
    odd, empty, n = folders
    query = entry.queries()[name]
    rows = query(spark, odd).collect()
    if name.startswith(PER_DOCUMENT):
        assert len(rows) in (n, n - 1) if name.startswith("op10_") else len(rows) == n
    if name.startswith(("op7_", "op11_")):
        assert all(r.held_out is not None for r in rows)
    if name == "pipeline":
        assert {r.doc_id for r in rows} <= {*range(100), None} and rows
    assert query(spark, empty).collect() == []


def test_anchors_read_in_parts_are_those_of_the_whole(monkeypatch):
    rng = random.Random(4)
    texts = [bytes(rng.choices(b"ab", k=k)) for k in (0, 199, 200, 201, 900, 5000)] + [b"a" * 700]
    whole = suffix_dedup.Anchors(texts)
    assert len(whole.text)
    for size in (1, 37, 256, 1000):
        monkeypatch.setattr(suffix_dedup, "PART", size)
        parts = suffix_dedup.Anchors(texts)
        for name in ("text", "first", "last", "place", "gram", "start"):
            assert (getattr(parts, name) == getattr(whole, name)).all(), (size, name)
        assert (parts.segments() == whole.segments()).all()


def test_words_hashed_in_parts_are_those_of_the_whole(monkeypatch):
    rng = random.Random(5)
    raw = np.frombuffer(bytes(rng.choices(b"abcde  \n", k=4000)) + b"x" * 900 + b" y", np.uint8)
    whole = shingles.word_hashes(raw)
    for size in (1, 7, 100, 4500):
        monkeypatch.setattr(shingles, "PART", size)
        parts = shingles.word_hashes(raw)
        assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    assert [len(x) for x in shingles.word_hashes(raw[:0])] == [0, 0]
