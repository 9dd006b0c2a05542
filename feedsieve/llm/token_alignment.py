"""How two tokenizers cut the same texts, and how often their tokens meet over the corpus.

Tokens of A and of B cover the same bytes. Every stretch between two neighbouring token ends of either
is the overlap of exactly one token of A with one of B: a link. Places where both end cut the
tokens into groups.

1. One pass encodes the texts, counts links and groups of each and deals the documents to blocks. For each pair
   of ids a block keeps compressed bitmaps of its documents, one for each binary digit of the number of
   links a document has (multiplicity planes): only bytes that are not zero are kept, with their places.
2. The planes of a pair, OR-merged and popcounted, give its documents; the popcount of each plane, times its
   digit, its links. Sums over blocks give the counts of the corpus, and the highest for each id of B.
3. Counts return along the bitmaps: each set bit adds its pair's count to a document of the block.

A block ends at ``BLOCK_DOCS`` documents or ``BLOCK_LINKS`` links, after whole documents. Counts of
pairs are broadcast as sorted arrays, ``MOST_PAIRS`` at a time (12 bytes each): pairs are dealt to
``PARTS`` parts, and parts that together hold more are read in passes of their own. A part can hold at most
the product of both vocabularies over ``PARTS``.

A text that B cannot give back byte by byte has no tokens, like an empty or a null one: zeros, and the
empty string for its groups. Repeated rows and rows without an id are documents of their own. Long texts are
encoded by B in parts, cut before a space that no piece of B can span, and aligned in stretches between
common ends. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from feedsieve.llm.byte_level import PATTERN, ranks_of_json
from feedsieve.llm.common import slices, stored, whole_text
from feedsieve.llm.pretokens import disputed

SPACE = "▁"  # stands for a space in pieces
PARTS = 64
BLOCK_DOCS = 1 << 16
BLOCK_LINKS = 4 << 20
MOST_PAIRS = 4_000_000
SLICE_BYTES = 1 << 20
PIECE_BYTES = 1 << 18


class Pieces:
    """B: its encoder and the bytes of each id."""

    def __init__(self, model_file: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.bytes = [
            bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        # Without a piece that goes on after a space, texts may be cut before one.
        self.divisible = not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def _divided(self, text: str) -> Iterator[str]:
        """Parts that, each with a space in front, give the text with a space in front."""
        at = 0
        while self.divisible and len(text) - at > PIECE_BYTES:
            cut = text.find(" ", at + PIECE_BYTES)
            while cut > 0 and text[cut - 1] == " ":
                cut = text.find(" ", cut + 1)
            if cut < 0 or cut + 1 == len(text):  # an empty part would lose its space
                break
            yield text[at:cut]
            at = cut + 1
        yield text[at:]

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= PIECE_BYTES:
            return np.array(self.model.encode(text, num_threads=1), np.int32)
        return np.concatenate([np.array(self.model.encode(t, num_threads=1), np.int32) for t in self._divided(text)])


class Pair:
    """Both tokenizers, kept for the life of a worker."""

    def __init__(self, json_file: str, model_file: str):
        vocab, _ = ranks_of_json(json_file)
        self.fast = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={})
        self.own = Tokenizer.from_file(json_file)
        self.own.encode_special_tokens = True  # their strings in a text are text
        self.in_dispute = regex.compile(f"[{regex.escape(disputed())}]").search if disputed() else None
        self.sizes_a = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        for token, number in vocab.items():
            self.sizes_a[number] = len(token)
        self.b = Pieces(model_file)
        self.n_b = len(self.b.bytes)
        # Decimal ids with what follows: inside a side, at its end.
        self.written = np.array(
            [b"%d%c" % (i, c) for i in range(len(self.sizes_a)) for c in b",|"]
            + [b"%d%c" % (i, c) for i in range(self.n_b) for c in b",;"],
            object,
        )

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B, or none if their bytes are not those of the text."""
        if not text:
            return None
        whole = " " + text
        b = self.b.encode(text)
        if b"".join([self.b.bytes[i] for i in b]) != whole.encode():
            return None
        # The faster library classes a few characters differently, if any: such texts go to the file's own.
        if self.in_dispute and not text.isascii() and self.in_dispute(text):
            a = self.own.encode(whole, add_special_tokens=False).ids
        else:
            a = self.fast.encode_ordinary(whole)
        return np.array(a, np.int64), b


@lru_cache(1)
def pair_of(json_file: str, model_file: str) -> Pair:
    return Pair(json_file, model_file)


class Aligned:
    """Links and groups of tokens that cover the same bytes."""

    def __init__(self, pair: Pair, a: np.ndarray, b: np.ndarray):
        self.a, self.b, self.pair = a, b, pair
        self.ends_a, self.ends_b = np.cumsum(pair.sizes_a[a]), np.cumsum(pair.b.sizes[b])
        size = int(self.ends_a[-1]) if len(a) else 0
        mark = np.zeros(size + 1, np.int8)
        mark[self.ends_a] = 1
        mark[self.ends_b] += 2
        self.ends = np.flatnonzero(mark)  # of links
        self.common = np.flatnonzero(mark == 3)  # of groups

    def keys(self) -> np.ndarray:
        """The pair of each link as one number."""
        a = self.a[np.searchsorted(self.ends_a, self.ends)]
        return a * self.pair.n_b + self.b[np.searchsorted(self.ends_b, self.ends)]

    def written(self) -> np.ndarray:
        """The groups as pieces of text, in order: one piece for each token."""
        group_a = np.searchsorted(self.common, self.ends_a)
        group_b = np.searchsorted(self.common, self.ends_b)
        upto_a = np.searchsorted(group_a, np.arange(len(self.common)), "right")
        upto_b = np.searchsorted(group_b, np.arange(len(self.common)), "left")
        code = np.empty(len(self.a) + len(self.b), np.int64)
        last_a = np.append(group_a[1:] != group_a[:-1], True)
        last_b = np.append(group_b[1:] != group_b[:-1], True)
        code[np.arange(len(self.a)) + upto_b[group_a]] = self.a * 2 + last_a
        code[np.arange(len(self.b)) + upto_a[group_b]] = (self.b + len(self.pair.sizes_a)) * 2 + last_b
        return self.pair.written[code]


def stretches(pair: Pair, a: np.ndarray, b: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The tokens of a long text, cut at common ends about every ``most`` bytes."""
    ends_a, ends_b = np.cumsum(pair.sizes_a[a]), np.cumsum(pair.b.sizes[b])
    if ends_a[-1] <= most:
        yield a, b
        return
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    wanted = np.searchsorted(common, np.arange(most, ends_a[-1], most))
    cuts = np.unique(np.append(common[wanted], common[-1]))
    to_a, to_b = np.searchsorted(ends_a, cuts) + 1, np.searchsorted(ends_b, cuts) + 1
    at_a = at_b = 0
    for i, j in zip(to_a.tolist(), to_b.tolist(), strict=True):
        yield a[at_a:i], b[at_b:j]
        at_a, at_b = i, j


class Block:
    """The links of some documents, turned into bitmaps when it is full."""

    def __init__(self, number: int):
        self.number, self.docs, self.links = number, 0, 0
        self.keys: list[np.ndarray] = []

    def add(self, keys: np.ndarray, slots: np.ndarray) -> None:
        self.keys.append(keys << 16 | slots)
        self.links += len(keys)

    def postings(self) -> Iterator[tuple[int, bytes, bytes, bytes, bytes, bytes]]:
        """For each part: pairs, and of each plane's byte its pair's place, plane, place and bits."""
        if not self.keys:
            return
        both, times = np.unique(np.concatenate(self.keys), return_counts=True)
        self.keys.clear()
        pair, slot = both >> 16, both & 0xFFFF
        part = part_of(pair)
        for p in np.unique(part).tolist():
            own = np.flatnonzero(part == p)
            pairs, which = np.unique(pair[own], return_inverse=True)
            slots, mult = slot[own], times[own]
            planes = []
            for digit in range(int(mult.max()).bit_length()):
                has = np.flatnonzero(mult >> digit & 1)
                place = which[has] << 13 | slots[has] >> 3
                first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(has) else has
                if not len(first):
                    continue
                bits = np.bitwise_or.reduceat((1 << (slots[has] & 7)).astype(np.uint8), first)
                planes.append((place[first], np.full(len(first), digit, np.uint8), bits))
            place, digit, bits = (np.concatenate(c) for c in zip(*planes, strict=True))
            yield (
                p,
                pairs.astype("<u4").tobytes(),
                (place >> 13).astype("<u4").tobytes(),
                digit.tobytes(),
                (place & 0x1FFF).astype("<u2").tobytes(),
                bits.tobytes(),
            )


def part_of(pair: np.ndarray) -> np.ndarray:
    return (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % PARTS


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    kinds = {"pairs": "<u4", "which": "<u4", "digit": "u1", "place": "<u2", "bits": "u1"}
    return tuple(np.frombuffer(row[name], kind).astype(np.int64) for name, kind in kinds.items())


POSTING = "part int, pairs binary, which binary, digit binary, place binary, bits binary"
DOC = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _indexed(docs: DataFrame, json_file: str, model_file: str, id_col: str, text_col: str, block_links: int) -> DataFrame:
    """Rows of documents (``slot`` given) and rows of postings (``part`` given), by block."""
    id_type = docs.schema[id_col].dataType
    layout = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("slot", T.IntegerType()),
            T.StructField("id", id_type),
            *T._parse_datatype_string(DOC).fields,
            *T._parse_datatype_string(POSTING).fields,
        ]
    )
    names = layout.fieldNames()
    n_doc, n_posting = 5, 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(json_file, model_file)
        number = TaskContext.get().partitionId() << 32
        block = Block(number)
        kinds = None

        def emptied() -> Iterator[pa.RecordBatch]:
            for posting in block.postings():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.number]), *(pa.nulls(1, k) for k in kinds[1 : 3 + n_doc])]
                    + [pa.array([v], k) for v, k in zip(posting, kinds[-n_posting:], strict=True)],
                    names=names,
                )

        for batch in batches:
            if kinds is None:
                kinds = [
                    pa.int64(), pa.int32(), batch.schema.field(0).type,
                    *[pa.int64()] * 4, pa.string(), pa.int32(), *[pa.binary()] * 5,
                ]
            for part in slices(batch, 1, SLICE_BYTES):
                for at in range(0, part.num_rows, BLOCK_DOCS):
                    rows = part.slice(at, BLOCK_DOCS)
                    if block.docs + rows.num_rows > BLOCK_DOCS or block.links >= block_links:
                        yield from emptied()
                        number += 1
                        block = Block(number)
                    slots = np.arange(rows.num_rows) + block.docs
                    found = _documents(pair, rows.column(1).to_pylist(), block, slots)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(rows.num_rows, block.number)),
                            pa.array(slots.astype(np.int32)),
                            rows.column(0),
                            *(pa.array(c, k) for c, k in zip(found, kinds[3 : 3 + n_doc], strict=True)),
                            *(pa.nulls(rows.num_rows, k) for k in kinds[-n_posting:]),
                        ],
                        names=names,
                    )
                    block.docs += rows.num_rows
        if kinds is not None:
            yield from emptied()

    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return texts.mapInArrow(run, layout)


def _documents(pair: Pair, texts: list[str], block: Block, slots: np.ndarray) -> tuple[list, ...]:
    """Columns of the documents; their links go to the block."""
    n = len(texts)
    counts = np.zeros((4, n), np.int64)
    shas = [""] * n
    encoded = [pair.encode(t) for t in texts]
    there = [i for i, e in enumerate(encoded) if e is not None]
    if n == 1 and there:
        a, b = encoded[0]
        digest, held = hashlib.sha256(), b""
        for part_a, part_b in stretches(pair, a, b, SLICE_BYTES):
            one = Aligned(pair, part_a, part_b)
            block.add(one.keys(), np.broadcast_to(slots, len(one.ends)))
            counts[:, 0] += len(part_a), len(part_b), len(one.common), len(one.ends)
            digest.update(held)
            held = b"".join(one.written().tolist())
        digest.update(held[:-1])
        shas[0] = digest.hexdigest()
    elif there:
        all_a, all_b = (np.concatenate([encoded[i][side] for i in there]) for side in (0, 1))
        n_a, n_b = (np.array([len(encoded[i][side]) for i in there]) for side in (0, 1))
        one = Aligned(pair, all_a, all_b)
        ends = one.ends_a[np.cumsum(n_a) - 1]
        owner = np.searchsorted(ends, one.ends)
        block.add(one.keys(), slots[np.array(there)][owner])
        counts[0, there], counts[1, there] = n_a, n_b
        counts[2, there] = np.bincount(np.searchsorted(ends, one.common), minlength=len(there))
        counts[3, there] = np.bincount(owner, minlength=len(there))
        pieces, at = one.written().tolist(), 0
        for i, size in zip(there, (n_a + n_b).tolist(), strict=True):
            shas[i] = hashlib.sha256(b"".join(pieces[at : at + size])[:-1]).hexdigest()
            at += size
    return (*counts.tolist(), shas)


def _counts(postings: DataFrame) -> DataFrame:
    """pair, documents and links of every pair, by popcounts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs, which, digit, place, bits = _read(row)
                ones = np.bitwise_count(bits).astype(np.int64)
                links = np.zeros(len(pairs), np.int64)
                np.add.at(links, which, ones << digit)
                # The planes of a pair, OR-merged: a byte of a place once.
                order = np.lexsort((place, which))
                which, place = which[order], place[order]
                first = np.flatnonzero(np.append(True, (which[1:] != which[:-1]) | (place[1:] != place[:-1])))
                merged = np.bitwise_or.reduceat(bits[order], first)
                docs = np.zeros(len(pairs), np.int64)
                np.add.at(docs, which[first], np.bitwise_count(merged).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (pairs, docs, links)], names=["pair", "n_docs", "n_links"]
                )

    return (
        postings.mapInArrow(run, "pair long, n_docs long, n_links long")
        .groupBy("pair")
        .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    )


def pair_counts(postings: DataFrame, n_b: int) -> DataFrame:
    """a, b, n_docs, n_links of every pair of the corpus and whether it is the best of its b."""
    same_b = Window.partitionBy("b")  # at most as many rows as A has ids
    return (
        _counts(postings)
        .withColumn("b", (F.col("pair") % n_b).cast("int"))
        .withColumn("a", F.expr(f"CAST(pair DIV {n_b} AS INT)"))
        .withColumn("best", F.col("n_links") == F.max("n_links").over(same_b))
    )


def _returned(postings: DataFrame, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> DataFrame:
    """block, slot, n_best, count_sum: what the pairs' counts add to each document."""
    shared = postings.sparkSession.sparkContext.broadcast((pairs, np.where(best, -counts, counts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, signed = shared.value
        held: dict[int, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for block, sums in held.items():
                slots = np.flatnonzero(sums.any(0))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(slots), block)),
                        pa.array(slots.astype(np.int32)),
                        *(pa.array(s[slots]) for s in sums),
                    ],
                    names=["block", "slot", "n_best", "count_sum"],
                )
            held.clear()

        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] not in held:
                    yield from flush()  # postings of a block lie together
                    held[row["block"]] = np.zeros((2, BLOCK_DOCS), np.int64)
                sums = held[row["block"]]
                pairs, which, digit, place, bits = _read(row)
                score = signed[np.searchsorted(known, pairs)]
                for bit in range(8):
                    has = np.flatnonzero(bits >> bit & 1)
                    if not len(has):
                        continue
                    slot, own = place[has] * 8 + bit, score[which[has]]
                    np.add.at(sums[0], slot, (own < 0).astype(np.int64) << digit[has])
                    np.add.at(sums[1], slot, np.abs(own) << digit[has])
        yield from flush()

    return postings.mapInArrow(run, "block long, slot int, n_best long, count_sum long")


def aligned_documents(
    docs: DataFrame,
    json_file: str,
    model_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_pairs: int = MOST_PAIRS,
    block_links: int = BLOCK_LINKS,
) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    indexed = stored(_indexed(docs, json_file, model_file, id_col, text_col, block_links), "alignment")
    own = indexed.where("slot IS NOT NULL").select("block", "slot", "id", *T._parse_datatype_string(DOC).names)
    postings = indexed.where("part IS NOT NULL").select("block", *T._parse_datatype_string(POSTING).names)
    scored = pair_counts(postings, pair_of(json_file, model_file).n_b)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = pa.array(part_of(batch.column(0).to_numpy()).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, numbers], names=[*batch.schema.names, "part"])

    scored = scored.select("pair", "n_links", "best").mapInArrow(part, "pair long, n_links long, best boolean, part int")
    scored = stored(scored, "pairs")
    sizes = sorted((r["part"], r["count"]) for r in scored.groupBy("part").count().collect())  # ``PARTS`` rows
    returned, turn, held = [], [], 0
    for number, size in [*sizes, (None, most_pairs)]:
        if turn and held + size > most_pairs:
            wanted = F.col("part").isin(turn)
            rows = scored.where(wanted).orderBy("pair").toArrow()
            known = [rows[c].to_numpy() for c in ("pair", "n_links", "best")]
            returned.append(_returned(postings.where(wanted), *known))
            turn, held = [], 0
        turn.append(number)
        held += size
    sums = "block long, slot int, n_best long, count_sum long"
    whole = docs.sparkSession.createDataFrame([], sums)
    for one in returned:
        whole = whole.unionByName(one)
    whole = whole.groupBy("block", "slot").agg(*(F.sum(c).alias(c) for c in ("n_best", "count_sum")))
    zero = F.lit(0).cast("long")
    return own.join(whole, ["block", "slot"], "left").select(
        F.col("id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        *(F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")),
        "groups_sha256",
    )
