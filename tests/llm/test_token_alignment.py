"""Token alignment against walking both token lists one by one."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from feedsieve.llm import token_alignment as A
from feedsieve.llm.byte_level import byte_alphabet

JSON = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
RESULT = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def one_by_one(rows):
    a_of, b_of = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    a_of.encode_special_tokens = True
    letters = byte_alphabet()
    vocab = a_of.get_vocab(with_added_tokens=False)
    bytes_a = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if all(c in letters for c in t)}
    bytes_b = []
    for i in range(b_of.vocab_size()):
        piece = b_of.id_to_piece(i)
        bytes_b.append(bytes([int(piece[3:5], 16)]) if b_of.is_byte(i) else piece.replace("▁", " ").encode())
    found, counts = [], Counter()
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        a = a_of.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        if not text or any(b"".join(own[i] for i in ids) != whole for own, ids in ((bytes_a, a), (bytes_b, b))):
            found.append((doc_id, 0, 0, 0, [], ""))
            continue
        links, groups, i, j = [], [([a[0]], [b[0]])], 0, 0
        end_a, end_b = len(bytes_a[a[0]]), len(bytes_b[b[0]])
        while True:
            links.append((a[i], b[j]))
            on_a, on_b = end_a <= end_b, end_b <= end_a
            if on_a and on_b and i + 1 == len(a):
                break
            if on_a and on_b:
                groups.append(([], []))
            if on_a:
                i += 1
                end_a += len(bytes_a[a[i]])
                groups[-1][0].append(a[i])
            if on_b:
                j += 1
                end_b += len(bytes_b[b[j]])
                groups[-1][1].append(b[j])
        counts.update(links)
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        found.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest()))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (d, na, nb, ng, len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), sha)
        for d, na, nb, ng, x, sha in found
    ], counts


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = ["hello", " ", "  ", "\n", "Überraschung", "日本語", "<s>", "<|endoftext|>", "'ll", "1234", "é", "x" * 40, "\x00", "🙂"]
    out = [(rng.choice([None, i, 2]), "".join(rng.choices(words, k=rng.choice([1, 5, 60])))) for i in range(60)]
    out += [(None, None), (5, ""), (6, "▁ lower one eighth"), (7, " lead"), (8, " "), (8, " ")]
    return out + [(9, "the same words again  and again " * 300)] * 3


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (0, v) for v in r))


@pytest.mark.parametrize("options", [{}, {"most_pairs": 40, "block_links": 500}])
def test_equals_walking_both_lists(spark, rows, options):
    """Also with small blocks and several passes."""
    docs = spark.createDataFrame(
        [(*r, 1, "x", 2, b"y") for r in rows],
        "doc_id long, text string, block int, slot string, part int, pairs binary",
    )
    got = A.aligned_documents(docs, JSON, MODEL, **options)
    assert got.columns == list(RESULT)
    assert order(got.collect()) == order(one_by_one(rows)[0])


def test_pairs_count_links_and_documents(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    indexed = A._indexed(docs, JSON, MODEL, "doc_id", "text", 1_000)
    n_b = A.pair_of(JSON, MODEL).n_b
    found = A.pair_counts(indexed.where("part IS NOT NULL"), n_b).collect()
    assert {(r.a, r.b): r.n_links for r in found} == dict(one_by_one(rows)[1])
    holding = Counter()
    for row in rows:
        holding.update(one_by_one([row])[1].keys())
    assert {(r.a, r.b): r.n_docs for r in found} == dict(holding)


def test_long_texts_in_parts_give_the_same(monkeypatch):
    pair = A.pair_of(JSON, MODEL)
    for text in ("the same  words   again\n " * 60, "x" * 900, " é日本" * 90, "word " * 200 + " "):
        whole, block = pair.encode(text), A.Block(0)
        alone = A._documents(pair, [text], block, np.arange(1))
        with monkeypatch.context() as patch:
            patch.setattr(A, "SLICE_BYTES", 100)
            patch.setattr(A, "PIECE_BYTES", 70)
            cut = pair.encode(text)
            assert all((a == b).all() for a, b in zip(whole, cut, strict=True))
            parts = list(A.stretches(pair, *cut, 100))
            assert len(parts) > 2 or "x" in text
            in_parts = A.Block(0)
            assert A._documents(pair, [text], in_parts, np.arange(1)) == alone
        assert list(block.postings()) == list(in_parts.postings())


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert A.aligned_documents(docs, JSON, MODEL).collect() == []
