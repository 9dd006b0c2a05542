"""Exact, near and substring duplicates against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedsieve.llm import deep_shallow, exact_dedup, ngram_join, queries, suffix_dedup

from . import brute

SCHEMA = "doc_id long, text string, h string, id string, n_chars long"


def corpus() -> list:
    rnd = random.Random(11)
    words = ["".join(rnd.choices("abcdé", k=rnd.randint(1, 7))) for _ in range(60)]

    def prose(n):
        return [rnd.choice(words) for _ in range(n)]

    base, line = prose(90), " ".join(prose(50))
    out = [" ".join(base)] * 4
    for _ in range(40):  # near copies around the threshold
        copy = list(base)
        for _ in range(rnd.randint(0, 5)):
            copy[rnd.randrange(len(copy))] = rnd.choice(words)
        out.append(" ".join(copy))
    for _ in range(20):  # a passage that unrelated texts share
        out.append(" ".join([*prose(30), line, *prose(30)]))
    out += [" ".join(prose(rnd.randint(0, 40))) for _ in range(60)]
    out += ["", None, "   ", "One two", "one  TWO", "x" * 700, "x" * 199, "x" * 200, "é" * 300, "a b c d e"]
    return out


@pytest.fixture(scope="module")
def rows():
    return [(i, t, "clash", "clash", None) for i, t in enumerate(corpus())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_deep_shallow_order_and_prefixes():
    rnd = random.Random(2)
    for _ in range(60):
        strings = [bytes(rnd.choices(b"ab", k=rnd.randint(0, 40))) for _ in range(rnd.randint(0, 40))]
        for shallow in (0, 8, 100):
            order, common = deep_shallow.deep_shallow_order(strings, shallow)
            assert sorted(order) == list(range(len(strings)))
            assert [strings[i] for i in order] == sorted(strings)
            for k in range(1, len(order)):
                pair = strings[order[k - 1]], strings[order[k]]
                assert common[k] == deep_shallow.common_prefix(*pair)


def test_few_and_many_segments_agree(monkeypatch):
    rnd = random.Random(4)
    core = bytes(rnd.choices(b"abc", k=60))
    for _ in range(20):
        left = [bytes(rnd.choices(b"ab", k=rnd.randint(0, 12))) for _ in range(9)]
        right = [core[: rnd.randint(40, 60)] + bytes(rnd.choices(b"ab", k=9)) for _ in range(9)]
        right = [r[:60] for r in right]
        covered = []
        for few in (0, 12):
            monkeypatch.setattr(suffix_dedup, "FEW", few)
            found = suffix_dedup.equal_offsets(left, right, 60)
            covered.append(
                [
                    {d for low, high in own for d in range(low, high + 1) if d <= len(a) and 60 - d <= len(b)}
                    for own, a, b in zip(found, left, right, strict=True)
                ]
            )
        assert covered[0] == covered[1]


@pytest.mark.parametrize("giant", [suffix_dedup.GIANT, 3])
def test_repeats_equal_brute_force(docs, rows, giant):
    left = suffix_dedup.remove_repeats(docs, giant=giant).withColumn("kept", F.sha2("kept", 256))
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in left.collect()}
    expected = brute.without_repeats([r[1] for r in rows])
    assert found == {r[0]: e for r, e in zip(rows, expected, strict=True)}


def test_texts_without_repeats_stay_documents(docs, nothing):
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    assert left.where("n_chars <> length(text)").count() == 0
    assert suffix_dedup.without_repeats(nothing).count() == 0


@pytest.mark.parametrize(("block", "frequent_in"), [(ngram_join.BLOCK, 3), (7, 2)])
def test_components_equal_brute_force(docs, rows, monkeypatch, block, frequent_in):
    monkeypatch.setattr(ngram_join, "FREQUENT_IN", frequent_in)
    monkeypatch.setattr(ngram_join.unconnected_pairs, "__defaults__", (block,))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_components(docs).collect()}
    assert found == brute.components({r[0]: r[1] for r in rows})


def test_bounds_hold_between_vectors_of_different_widths():
    rnd = np.random.default_rng(6)
    for n in (1, 3, 100, 127, 128, 1_000, 9_000):
        for m in (n, n + n // 4):
            both = rnd.integers(0, 2**63, n // 2 + 1).astype(np.uint64)
            a, b = (np.append(both, rnd.integers(0, 2**63, k - len(both)).astype(np.uint64)) for k in (n, m))
            u, v = (ngram_join.count_vector(x)[None] for x in (a, b))
            groups = min(u.shape[1], v.shape[1])
            u, v = ngram_join.folded(u, groups), ngram_join.folded(v, groups)
            assert u.sum() == n and v.sum() == m
            assert len(both) <= ngram_join.overlap_bound(u, v)[0] <= n
    full = np.full((1, 128), 200, np.uint8)
    assert ngram_join.overlap_bound(*[ngram_join.folded(full, 64)] * 2)[0] > 128 * 200


def test_links_between_long_texts_of_different_widths(spark):
    rnd = random.Random(8)
    line = [f"l{k}" for k in range(40)]
    texts = {}
    for i in range(24):  # texts that share a line; each third one is a longer copy of the one before
        if i % 3 == 1:
            own = [*own, *(f"x{i}w{k}" for k in range(rnd.randint(5, 40)))]
        else:
            own = [f"d{i}w{k}" for k in range(rnd.randint(190, 300))] + line
        texts[i] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_components(docs).collect()}
    assert found == brute.components(texts)
    assert any(i != c for i, (_, c) in found.items())


def test_join_of_nothing_and_of_rows_without_ids(spark, nothing):
    assert ngram_join.near_components(nothing).count() == 0
    odd = spark.createDataFrame(
        [(None, "a b c d e f", "", "", 1), (3, "a b c d e f", "", "", 1), (3, "a b c d e f", "", "", 1)], SCHEMA
    )
    found = ngram_join.near_components(odd).collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in found] == [(3, 2, 3)]


def test_exact_groups_even_when_hashes_collide(spark, rows, nothing):
    extra = [(None, " ".join("ab"), "", "", 1), (500, "a\t\nb", "", "", 1), (501, "a b", "", "", 1), (None, "q", "", "", 1)]
    docs = spark.createDataFrame([*rows, *extra], SCHEMA)

    def weak(text):
        return F.unhex(F.substring(F.md5(text), 1, 2))

    strong = sorted(map(tuple, exact_dedup.exact_groups(docs).collect()), key=str)
    assert strong == sorted(map(tuple, exact_dedup.exact_groups(docs, digest=weak).collect()), key=str)
    by_id = {r[0]: r for r in strong}
    assert by_id[3][1:4] == (0, 4 + sum(r[1] == rows[0][1] for r in rows[4:]), False)
    assert by_id[501][1:4] == (500, 3, False)
    assert exact_dedup.drop_copies(docs).columns == docs.columns
    kept = [r for r in strong if r[3]]
    assert exact_dedup.drop_copies(docs.where("doc_id IS NOT NULL")).count() == len(kept) - 1
    assert exact_dedup.exact_groups(nothing).count() == 0


def test_copies_go_by_id_and_text(spark, rows):
    extra = [(None, "a b"), (500, "a\t\nb"), (501, "a b"), (None, "q"), (None, "r"), (7, "a b"), (7, "alone")]
    docs = spark.createDataFrame([*rows, *((i, t, "", "", 1) for i, t in extra)], SCHEMA)

    def told(found):
        return sorted(map(str, found.collect()))

    kept = exact_dedup.exact_groups(docs).where("kept").select("doc_id", "text_sha256")
    sha = F.sha2(exact_dedup.normalised("text"), 256)
    left = exact_dedup.drop_copies(docs)
    assert told(left.select("doc_id", sha.alias("text_sha256"))) == told(kept)
    assert {r.text for r in left.where("doc_id IS NULL").collect()} == {"q", "r"}
    # The smallest id that carries "a b" is 7, whose other texts are left alone.
    assert {"a b", "alone"} <= {r.text for r in left.where("doc_id = 7").collect()}
    assert left.where("doc_id IN (500, 501)").count() == 0


def test_near_copies_without_an_id_or_with_a_repeated_one(spark, tmp_path):
    def text(name, last=0):
        return " ".join([*(f"{name}{k}" for k in range(60)), *(f"{name}x{last}" for _ in range(last))])

    rows = [
        (4, text("p")), (None, text("p", 2)), (None, text("p", 3)), (9, text("p", 1)),  # all near copies
        (None, text("q")), (None, text("q", 1)), (None, text("q").upper()),  # no id among them
        (5, text("p", 4)), (5, text("r")), (6, text("r", 1)),  # one id, two texts
        (None, text("s")), (None, None), (7, ""),
    ]
    schema = "doc_id long, text string, sha string, own string"
    docs = spark.createDataFrame([(i, t, "", "") for i, t in rows], schema)
    numbers = {n: (i, t) for n, (i, t) in enumerate(rows)}
    alike = brute.components({n: t for n, (_, t) in numbers.items()})
    groups = {}
    for n, (_, least) in alike.items():
        groups.setdefault(least, []).append(n)
    least_id = {
        n: min((rows[m][0] for m in members if rows[m][0] is not None), default=None)
        for members in groups.values()
        for n in members
    }
    found = ngram_join.near_components(docs, nameless=True).collect()
    expected = [(i, alike[n][0], least_id[n]) for n, (i, _) in numbers.items()]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op10_ngram_join(spark, str(tmp_path)).count() == len(rows)

    left = ngram_join.keep_smallest(docs)
    assert left.columns == docs.columns
    left = [(r.doc_id, r.text) for r in left.collect()]
    own = [r for r in left if "q" in (r[1] or "").lower()]
    assert len(own) == 1 and own[0] in rows
    assert sorted(map(str, set(left) - set(own))) == sorted(
        map(str, [(4, text("p")), (5, text("r")), (None, text("s")), (None, None), (7, "")])
    )
