"""Language identification: features, clusters, held-out accuracy and odd rows."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedsieve.llm import language_id as L
from feedsieve.llm.queries import op11_language_id

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def grams(text):
    """The n-grams of a text as tuples of letters, by plain loops."""
    out, before = [], []
    for char in text + "\n":
        code = char.lower() if len(char.lower()) == 1 else char
        code = code if char.isalpha() else ""
        if code == "" and (not before or before[-1] == ""):
            continue
        whole = (before or [""]) + [code]
        if code:
            out.append((code,))
        out.append(tuple(whole[-2:]))
        if len(whole) > 2 and whole[-2]:
            out.append(tuple(whole[-3:]))
        before = whole
    return out


def test_counts_are_those_of_the_grams():
    rng = random.Random(1)
    texts = ["", "!", "a", "Éa ß", "..ab  cD1e", "İx日本"] + ["".join(rng.choices("aBç. 1", k=50)) for _ in range(20)]
    together = L.gram_counts(texts)
    kinds = {}
    for text, row in zip(texts, together, strict=True):
        assert row.sum() == len(grams(text))
        assert (L.gram_counts([text])[0] == row).all()
        for gram in set(grams(text)):
            kinds.setdefault(gram, set())
    # Equal multisets of grams give equal rows.
    assert (L.gram_counts(["ab cd"]) == L.gram_counts(["..AB, cd!"])).all()


def test_long_texts_count_alike_in_parts(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("ab ç.X") for _ in range(501))
    whole = L.gram_counts([text])
    for size in (1, 2, 50, 500):
        monkeypatch.setattr(L, "SLICE_BYTES", size)
        assert (L._long_counts(text) == whole).all()


def test_clusters_part_what_is_apart():
    rng = np.random.Generator(np.random.PCG64(1))
    centres = np.eye(4, 30)
    rows = np.repeat(centres, 25, 0) + rng.normal(0, 0.02, (100, 30))
    rows = (rows / np.sqrt((rows**2).sum(1, keepdims=True))).astype(np.float32)
    centroids, member = L.spherical_centroids(rows, 4)
    assert len({tuple(member[i * 25 : i * 25 + 25]) for i in range(4)}) == 4
    assert np.allclose((centroids**2).sum(1), 1, atol=1e-5)
    assert len(L.spherical_centroids(rows[:2], 4)[0]) <= 2


def test_query_on_the_test_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = op11_language_id(spark, SF_DIR).collect()
    assert len(found) == docs.count()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    out = [r for r in found if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in found)
    again = op11_language_id(spark, SF_DIR).collect()
    assert sorted(found) == sorted(again)


@pytest.fixture(scope="module")
def mixed(spark):
    words = {"de": "der hund und die katze schlafen auf dem sofa", "en": "the dog and the cat sleep on the sofa"}
    rng = random.Random(2)
    rows = [
        (i, " ".join(rng.choices(text.split(), k=12)), lang, None, 1)
        for i in range(300)
        for lang, text in words.items()
    ]
    odd = [
        (None, "der hund und die katze", "en", None, 1),
        (900, None, "en", None, 1),
        (901, "", "de", None, 1),
        (902, "12 34 !?", None, None, 1),
        (903, "日本語 テキスト です", None, None, 1),
        (904, "the cat and the dog " * 90_000, None, None, 1),
        (905, "THE CAT AND THE DOG", None, None, 1),
    ]
    rows += odd + [(7, "the dog and the cat on the sofa", "en", None, 1)] * 50
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, nearest string, score int")


def test_odd_rows(mixed):
    found = L.identify(mixed, L.fit(mixed)).where("doc_id >= 900 OR doc_id IS NULL").collect()
    told = {r.doc_id: (r.nearest, r.language, r.rejected) for r in found}
    assert told[None][0] == "de"
    for doc_id in (900, 901, 902):
        assert told[doc_id] == ("und", "und", True)
    assert told[903][1:] == ("und", True)  # too far from all centroids
    assert told[904][0] == told[905][0] == "en"
    ids = mixed.select(L.held_out().alias("h"), "doc_id")
    assert ids.where("doc_id IS NULL AND h").isEmpty()


def test_sample_is_bounded_with_repeated_rows(mixed):
    many = mixed.withColumn("lang", F.coalesce("lang", F.lit("en")))
    rows = L.training_rows(many, "doc_id", "text", "lang", sample=20)
    per_lang = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    assert per_lang.keys() == {"de", "en"} and max(per_lang.values()) <= 20
    assert L.training_rows(many, "doc_id", "text", "lang", 20, 1).select("lang").distinct().count() == 1


def test_nothing_to_learn_and_empty_table(spark, mixed):
    blank = mixed.withColumn("lang", F.lit(None).cast("string")).limit(5)
    assert {(r.nearest, r.score) for r in L.identify(blank, L.fit(blank)).collect()} == {("und", 0.0)}
    assert L.identify(mixed.limit(0), L.fit(mixed.limit(0))).collect() == []
