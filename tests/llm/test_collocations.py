"""Phrase collocations against counting every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from feedsieve.llm import collocations as C
from feedsieve.llm.double_array import double_array

SCHEMA = "doc_id long, text string, lang string, w1 string, ids binary, block long, word string"
RESULT = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def by_counting(rows, support, top=2000):
    found, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, raw = lang or "und", (text or "").encode()
        raw = raw.translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
        for piece in re.split(rb"[.,;:!?\n\x0b\x0c\r]", raw):
            words = [w for w in re.split(rb"[ \t]+", piece) if w]
            sizes[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    found[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in found.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        held = Counter()
        for p, a in frequent.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    held[p[i : i + m]] = max(held[p[i : i + m]], a)
        scored = []
        for p, a in frequent.items():
            if not (p in held and 100 * held[p] >= 100 * a):
                cuts = ((1000 * a * sizes[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                score, k = min(cuts)
                scored.append((-score, -a, b" ".join(p), counts[p[:k]], counts[p[k:]]))
        for i, (score, a, p, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["a", "the", "über", "cat", "Sat", "x" * 300, "日本", "o\x1cn", "<s>", "it's", "b-c"]
    out = []
    for i in range(160):
        n = rng.choice([0, 1, 3, 30, 60])
        text = "".join(rng.choice(words[: rng.randint(3, 11)]) + rng.choice([" ", " ", "\t", "  ", ". ", "\n", ", "]) for _ in range(n))
        out.append((rng.choice([None, i, 3]), text, rng.choice(["en", "de", None, "a\nb"]), "the", b"x", 1, "cat"))
    out += [(None, None, "en", None, None, None, None), (1, "", None, None, None, None, None)]
    out += [(7, "one long piece " * 400, "en", None, None, None, None)] * 3
    return out


@pytest.mark.parametrize("support,most", [(6, 500_000), (5, 60)])
def test_equals_counting_every_phrase(spark, rows, support, most):
    """Also with tries of sixty keys and lots of sixty buckets, so with many of them in each level."""
    docs = spark.createDataFrame(rows, SCHEMA)
    got = C.collocations(docs, support=support, most_keys=most, most_hot=most).select(*RESULT).collect()
    expected = by_counting([(r[2], r[1]) for r in rows], support)
    assert sorted(map(tuple, got)) == expected
    assert {len(r.phrase.split(" ")) for r in got} >= {2, 5}


def test_texts_read_in_parts_give_the_same_numbers(monkeypatch):
    trie = double_array([b"en\nab", b"en\nb", b"en\nover"])
    plain = b"ab b  over x\nab ab\n\n b over " * 9 + b"\n"
    ends, roots = np.array([120, len(plain)]), np.full(2, trie.state_of(b"en\n"), np.int32)
    whole = C.numbered(plain, ends, roots, trie)
    assert (whole > 0).sum() == 9 * 7 and (whole[:4] == [1, 2, 3, 0]).all()
    for size in (1, 5, 40):
        monkeypatch.setattr(C, "SLICE_BYTES", size)
        assert len(list(C._cut(plain))) > 5
        assert (C.numbered(plain, ends, roots, trie) == whole).all()


def test_top_and_ties(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = C.collocations(docs, support=6, top=5).select(*RESULT).collect()
    assert sorted(map(tuple, got)) == by_counting([(r[2], r[1]) for r in rows], 6, 5)


def test_nothing_frequent_and_empty_table(spark, rows):
    docs = spark.createDataFrame(rows[:3], SCHEMA)
    assert C.collocations(docs).collect() == []
    assert C.collocations(docs.limit(0)).collect() == []


def test_products_beyond_64_bits_are_exact(spark):
    score = "CAST((CAST(1000 AS DECIMAL(4, 0)) * CAST(a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0)))"
    score += " DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0))) AS BIGINT) AS s"
    a, n, left, right = 10**13 + 7, 10**14 + 3, 3 * 10**13 + 1, 2 * 10**13 + 9
    found = spark.sql(f"SELECT {score} FROM VALUES ({a}L, {n}L, {left}L, {right}L) AS v(a, n, l, r)").first()
    assert found.s == 1000 * a * n // (left * right)


def test_double_array_holds_its_keys_and_no_others():
    rng = random.Random(2)
    keys = sorted({bytes(rng.choices(b"ab\x00\xff", k=rng.randint(1, 6))) for _ in range(900)})
    keys += sorted({b"z" + bytes((i, j)) for i in range(256) for j in (0, 200, 255)})
    trie = double_array(keys)
    for i, key in enumerate(keys):
        assert trie.value[trie.state_of(key)] == i + 1
    for _ in range(500):
        other = bytes(rng.choices(b"abz\x00\xff", k=rng.randint(1, 7)))
        state = trie.state_of(other)
        assert (state >= 0 and trie.value[state] > 0) == (other in set(keys))
    assert double_array([]).state_of(b"a") == -1


@pytest.mark.parametrize("apart", [True, False])
def test_windows_that_share_a_bucket_are_counted_apart(spark, rows, monkeypatch, apart):
    """A bucket is as hot as its most frequent window, not as all of its windows together."""
    docs = spark.createDataFrame([("a b x a c x d b", "en")] * 3, "text string, lang string")
    plain = C._bucket
    if not apart:
        monkeypatch.setattr(C, "_bucket", lambda ids, at, width, seed=0: plain(ids, at, width, 1) * seed)
    found = []
    hot = C._hot_buckets
    monkeypatch.setattr(C, "_hot_buckets", lambda *a: found.append(hot(*a)) or found[-1])
    got = C.collocations(docs, support=3).select(*RESULT).collect()
    assert sorted(map(tuple, got)) == by_counting([("en", "a b x a c x d b")] * 3, 3)
    assert found[0].columns == ["bucket", "owner"]
    assert {r.owner == -1 for r in found[0].collect()} == {not apart}
