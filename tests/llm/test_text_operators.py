"""Tokens, codec, packing, shards: against the libraries and by round trips."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer, pre_tokenizers

from feedsieve.llm import bpe_codec, byte_level, packing, sharding, token_counts
from feedsieve.llm.pretokens import CHUNK, split

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, ids string, shard int, offset long"

PARTS = [
    "the", " the", "ing", "'s", "'re", "'ll", "'S", "'", "''", " ", "   ", "\n", "\r\n", "\t", "1", "23",
    "!", "?!", "<|endoftext|>", "é", "漢", " ", "　", "\x85", "\x1c", "​", "😀", "ĳ", "½", "\0",
]


def texts() -> list:
    rnd = random.Random(3)
    mixed = ["".join(rnd.choices(PARTS, k=rnd.randint(0, 30))) for _ in range(300)]
    wide = ["".join(chr(rnd.randrange(32, 0xD000)) for _ in range(20)) for _ in range(100)]
    edges = [" " * (CHUNK - 1) + "'re x", "a" * (2 * CHUNK), "'s" * CHUNK, "th" * 3000, "", None]
    return [*mixed, *wide, *edges, *edges]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 7, None) for i, t in enumerate(texts())]
    return spark.createDataFrame([*rows, (None, "no id", "x", 7, None)], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_pretokens_are_those_of_the_library():
    library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    for text in texts():
        text = text or ""
        words, ends = split([text], "tokenizers")
        expected = [text[i:j] for _, (i, j) in library.pre_tokenize_str(text)]
        assert words[: ends[0] - 1] == expected


def test_counts_equal_the_library(docs, nothing):
    own = Tokenizer.from_file(JSON)
    found = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, JSON).collect()}
    for i, text in enumerate(texts()):
        text = text or ""
        expected = len(own.encode(text, add_special_tokens=False).ids)
        assert found[i] == (len(text.encode()), expected)
    assert None in found
    assert token_counts.count_tokens(nothing, JSON).count() == 0


def test_codec_equals_the_library_and_decodes(docs, nothing):
    library = tiktoken.Encoding(
        "own", pat_str=byte_level.PATTERN, mergeable_ranks=byte_level.read_ranks(RANKS), special_tokens={}
    )
    both = bpe_codec.decode_ids(bpe_codec.encode_documents(docs, RANKS), RANKS)
    found = {r.doc_id: r for r in both.collect()}
    for i, text in enumerate(texts()):
        assert found[i].ids == library.encode_ordinary(text or "")
        assert bytes(found[i].decoded) == (text or "").encode()
    assert bpe_codec.decode_ids(bpe_codec.encode_documents(nothing, RANKS), RANKS).count() == 0


@pytest.mark.parametrize("wide", [1, 5, 48, 1_000_000])
def test_merging_side_by_side_and_in_turn_agree_with_the_library(monkeypatch, wide):
    monkeypatch.setattr(bpe_codec, "WIDE", wide)
    ranks = byte_level.read_ranks(RANKS)
    library = tiktoken.Encoding(
        "own", pat_str=byte_level.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    codec, rnd = bpe_codec.Codec(ranks), random.Random(5)
    assert codec.sinking
    several = ["a" * n + "b" * (n % 7) for n in range(1, 60)]
    several += ["".join(rnd.choices(s, k=40)) for s in ("ab", "aab ", "ther", "漢é", "=-", "01") * 20]
    for batch in ([t or "" for t in texts()], several, [" ".join(several)], [""], []):
        found = [np.frombuffer(p, np.int32).tolist() for p in codec.packed(batch)]
        assert found == [library.encode_ordinary(t) for t in batch]


def test_a_byte_outside_the_vocabulary_is_refused():
    codec = bpe_codec.Codec({b"a": 0, b"b": 1, b"ab": 2})
    assert codec.encode("abba") == [2, 1, 0]
    with pytest.raises(ValueError, match="vocabulary"):
        codec.encode("abc")


def test_rank_queue_gives_the_lowest_rank_and_positions_in_order():
    queue, rnd = bpe_codec.RankQueue(5000), random.Random(1)
    pushed = defaultdict(list)
    for position in rnd.sample(range(10_000), 2_000):
        rank = rnd.randrange(5000)
        queue.push(rank, position)
        pushed[rank].append(position)
    popped = []
    while queue.top:
        popped.append(queue.pop())
    assert popped == [(r, sorted(p)) for r, p in sorted(pushed.items())]


def test_best_fit_holds_its_bounds():
    rnd = random.Random(5)
    lengths = [rnd.randint(1, 1024) for _ in range(3000)]
    for open_bins in (1, 3, 4096):
        bins, offsets = packing.best_fit(lengths, 1024, open_bins)
        used = defaultdict(int)
        for b, offset, length in zip(bins, offsets, lengths, strict=True):
            assert offset == used[b]
            used[b] += length
        assert max(used.values()) <= 1024
    descending = sorted(lengths, reverse=True)
    assert max(packing.best_fit(descending, 1024, 4096)[0]) + 1 <= sum(lengths) / 1024 * 1.01 + 1


def test_pieces_hold_every_token_once(docs, nothing):
    own = Tokenizer.from_file(JSON)
    packed = packing.pack_documents(docs, JSON, capacity=64, bucket_pieces=200).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in packed:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, text in enumerate(texts()):
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert len(pieces) == -(-len(ids) // 64)
        at = 0
        for p in pieces:
            part = np.array(ids[at : at + p.length], "<u4")
            assert (p.start, p.ids_crc32) == (at, zlib.crc32(part))
            at += p.length
        assert at == len(ids)
        assert all(p.length == 64 for p in pieces[1:])
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(nothing, JSON).count() == 0


def test_missing_and_repeated_ids_fill_no_bucket(spark):
    unnamed = [(None, 0, 0, 1 + n % 50, n) for n in range(2000)]
    equal = [(None, 0, 0, 7, 1), (8, 0, 0, 9, 2)] * 1000
    own = [(n, 0, 0, 5, 3) for n in range(100, 2100)]
    layout = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = spark.createDataFrame([*unnamed, *equal, *own], layout)
    packed = packing.pack(pieces, 20, 64)
    buckets = {r[0]: r[1] for r in packed.groupBy(packed.sequence_id.bitwiseAND(-1 << 32)).count().collect()}
    assert sum(buckets.values()) == 6000
    assert max(buckets.values()) < 600
    sizes = packed.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in sizes) <= 64


def test_shards_are_even_whole_and_repeatable(docs, nothing, tmp_path):
    def run(seed):
        return sharding.shuffle_shards(docs, 5, seed=seed, bucket_bytes=4096)

    rows = run(1).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1

    def digest(found):
        return sorted((str(r.doc_id), hashlib.md5(str(r.text).encode()).hexdigest()) for r in found)

    assert digest(rows) == digest(docs.collect())
    place = {(r.doc_id, r.text): (r.shard, r.slot) for r in rows}
    assert place == {(r.doc_id, r.text): (r.shard, r.slot) for r in run(1).collect()}
    assert place != {(r.doc_id, r.text): (r.shard, r.slot) for r in run(2).collect()}
    sharding.write_shards(run(1), str(tmp_path / "shards"))
    assert docs.sparkSession.read.parquet(str(tmp_path / "shards")).count() == len(rows)
    assert sharding.shuffle_shards(nothing).count() == 0
