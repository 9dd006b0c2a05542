"""Search, preference pairs, toxicity, the registered queries and the pipeline."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from feedsieve.llm import chat_format, queries, topk, toxicity

from . import brute
from ..compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_top_k_equals_brute_force(spark):
    rnd = random.Random(7)
    vectors = [[rnd.gauss(0, 0.3) for _ in range(6)] for _ in range(150)]
    vectors += [vectors[0]] * 40 + [[0.0] * 6] * 5 + [[0.5, 0.25]] * 3
    rows = [(i, v, "x", "y") for i, v in enumerate(vectors)]
    unusable = [
        (900, None), (910, [1.0, None, 0, 0, 0, 0]), (920, [math.nan] * 6), (930, [math.inf] * 6), (None, [0.1] * 6)
    ]
    unusable = [(i, v and [x if x is None else float(x) for x in v], "x", "y") for i, v in unusable]
    table = spark.createDataFrame(
        [*rows, *unusable, rows[10]], "vec_id long, embedding array<float>, v string, floor string"
    )
    whole = topk.integer_vectors(table)
    exact = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, _, _ in rows
    ]
    for shard_rows, block_rows in ((8192, 4096), (20, 4)):
        found = topk.top_k(whole.where("id % 10 = 0"), whole, 7, shard_rows, block_rows)
        expected = brute.top_k(exact, [e for e in exact if e[0] % 10 == 0], 7)
        assert sorted(map(tuple, found.collect())) == sorted(expected)
    nothing = topk.integer_vectors(table.limit(0))
    assert topk.top_k(nothing, nothing).count() == 0


def test_repeated_queries_raise_no_floor(spark):
    # The first of 8 shards holds fewer than k candidates, but the best ones.
    ids = spark.range(60).select("id", F.expr("pmod(xxhash64(id), 8) = 0").alias("first")).collect()
    exact = [(r.id, [r.id + 1000 * r.first, 1]) for r in ids]
    assert 2 <= sum(r.first for r in ids) < 10
    vectors = spark.createDataFrame(exact, "id long, v array<bigint>")
    asked = spark.createDataFrame([exact[5]] * 8, vectors.schema)
    found = sorted(map(tuple, topk.top_k(asked, vectors, 10, 8).collect()))
    assert found == sorted(brute.top_k(exact, [exact[5]], 10))


def test_prompt_is_the_common_prefix(spark):
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (1, 3, "assistant", "b"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "a"), (2, 2, "user", "other"), (2, 3, "assistant", "b"),
        (3, 0, "user", "hi"), (3, 0, "user", "hi"), (5, None, None, None), (4, 0, "user", ""), (None, 0, "user", "x"),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").withColumn(
        "part", F.lit("clash")
    )
    own = chat_format.turns_of(table)
    pairs = chat_format.pairs_by_opening(own)
    assert sorted(map(tuple, pairs.collect())) == [(2, 1, 2), (3, 1, 3), (5, 4, 5)]
    found = {(r.pair_id, r.part, r.turn): (r.rendered, r.loss) for r in chat_format.preference_segments(own, pairs).collect()}
    assert found[2, "prompt", 1] == ("<|assistant|>\na\n", False)
    assert found[2, "chosen", 2] == ("<|user|>\nmore\n", False)
    assert found[2, "rejected", 3] == ("<|assistant|>\nb\n", True)
    assert (2, "prompt", 2) not in found
    assert found[3, "chosen", 1] == ("<|assistant|>\na\n", True)
    assert {part for pair, part, _ in found if pair == 3} == {"prompt", "chosen"}
    empty = chat_format.turns_of(table.limit(0))
    assert chat_format.preference_segments(empty, chat_format.pairs_by_opening(empty)).count() == 0


def test_toxicity_learns_words_and_beginnings(spark):
    rnd = random.Random(9)
    plain = ["".join(rnd.choices("aeiounrst", k=5)) for _ in range(200)]
    docs, labels = [], []
    for i in range(1200):
        words = rnd.choices(plain, k=30)
        toxic = i % 8 == 0
        if toxic:
            words[rnd.randrange(30)] = rnd.choice(["Grumble", "zorpish", "zorpest", "zorpal"])
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    docs += [(2000, None, "x"), (2001, "", "x"), (None, "grumble", "x")]
    labels += [(2001, None), (None, 1), (9999, 1)]
    table = spark.createDataFrame(docs, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(table, marks)
    scored = {r.doc_id: r.score for r in toxicity.score_texts(table, model).collect()}
    held = {r.doc_id for r in table.where(toxicity.held_out()).collect()}
    assert 0 < len(held) < 500
    for i in held & set(range(1200)):
        assert (scored[i] >= 0.3) == (i % 8 == 0)
    assert scored[2000] == scored[2001] < 0.3 <= scored[None]
    kept = toxicity.keep_clean(table, model, 0.3)
    assert kept.columns == table.columns
    assert kept.count() == sum(s < 0.3 for s in scored.values())
    for none in (marks.limit(0), marks.where("toxic = 0")):
        unlearnt = toxicity.fit(table, none)
        assert {r.score for r in toxicity.score_texts(table, unlearnt).collect()} == {0.0} or max(
            r.score for r in toxicity.score_texts(table, unlearnt).collect()
        ) < 1e-9


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    assert difference(entry.queries()[name](spark, SF_DIR), connect(SF_DIR), entry.oracle_sql()[name]) is None


def test_every_operator_is_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def test_pipeline_stages_follow_one_another(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns, name
        rows = kept.collect()
        now = {r.doc_id for r in rows}
        assert len(rows) == len(now) and now <= ids
        if name == "ngram_join":
            found = brute.components({r.doc_id: r.text for r in docs.collect()})
            assert now == {c for _, c in found.values()}
        docs, ids = spark.createDataFrame(rows, docs.schema), now
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in packed} == ids
