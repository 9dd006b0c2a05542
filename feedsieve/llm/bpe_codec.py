"""Byte-level BPE by a rank queue, and its inverse.

The tokens of a text stand in a doubly linked list. Each possible merge waits in the
bucket of its rank, as the position of its left token; a two-level bitmap over ranks
gives the next rank by two find-first-set steps, so a merge costs a constant however
long the pre-token is. An entry whose tokens have changed since is stale and skipped.

All pre-tokens of a slice that are not in the worker's memory go through one
queue together, with fences between them: merges never cross a fence, so the order of
ranks within each stays what it would be alone. The memory of pre-tokens is bounded.

Null text is the empty text, without ids. Rows are independent of one another:
repeated rows give equal results, an empty table an empty one, and only the id and the
text are read. Bytes outside the vocabulary are refused.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.llm.byte_level import read_ranks
from feedsieve.llm.common import slices, whole_text
from feedsieve.llm.pretokens import FENCE, split

REMEMBERED = 300_000
SLICE_BYTES = 4 << 20
WORD_BITS = 256
WIDE = 48  # positions in a bucket from which they are merged side by side


class RankQueue:
    """Positions by merge rank; the lowest rank first."""

    def __init__(self, ranks: int):
        self.words = [0] * (ranks // WORD_BITS + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.open(rank, [position])
        else:
            bucket.append(position)

    def open(self, rank: int, positions: list[int]) -> None:
        """The first positions of a rank."""
        self.buckets[rank] = positions
        word = rank // WORD_BITS
        self.words[word] |= 1 << rank % WORD_BITS
        self.top |= 1 << word

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank and its positions from left to right."""
        word = (self.top & -self.top).bit_length() - 1
        bits = self.words[word]
        rank = word * WORD_BITS + (bits & -bits).bit_length() - 1
        self.words[word] = bits = bits & (bits - 1)
        if not bits:
            self.top ^= 1 << word
        return rank, sorted(self.buckets.pop(rank))


class Codec:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.token = [b""] * self.size
        for token, rank in ranks.items():
            self.token[rank] = token
        self.byte = np.array([ranks.get(bytes((b,)), -1) for b in range(256)])
        self.pair_rank = self._pairs()
        self.pairs = np.array(sorted(self.pair_rank), np.int64)
        self.pair_ranks = np.array([self.pair_rank[k] for k in self.pairs.tolist()], np.int64)
        left, right = np.divmod(self.pairs, self.size)
        # Tokens that can take part in a merge of lower rank than their own.
        sinking = [side[side > self.pair_ranks] for side in (left, right)]
        self.sinking = set(np.concatenate(sinking).tolist())
        every = np.arange(256)
        self.byte_pairs = self._ranks(
            np.repeat(self.byte, 256), self.byte[np.tile(every, 256)]
        ).reshape(256, 256)
        self.seen: dict[str, bytes] = {}
        lengths = np.array([len(t) for t in self.token], np.int64)
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.alphabet = np.frombuffer(b"".join(self.token), np.uint8)

    def _pairs(self) -> dict[int, int]:
        """The rank of every pair of tokens that merges."""
        found, rank_of, size = {}, self.ranks.get, self.size
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                if (a := rank_of(token[:cut])) is not None:
                    if (b := rank_of(token[cut:])) is not None:
                        found[a * size + b] = rank
        return found

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of many pairs; -1 where they don't merge."""
        if not len(self.pairs):
            return np.full(len(left), -1)
        key = np.where((left < 0) | (right < 0), -1, left * self.size + right)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], -1)

    def _queue(self, words: list[bytes], ids: np.ndarray, fences: np.ndarray) -> RankQueue:
        """Lays out the bytes of the words and queues the pairs that merge."""
        text = np.frombuffer(b"".join(words), np.uint8)
        ids[:] = -1
        inside = np.ones(len(ids), bool)
        inside[fences] = False
        ids[inside] = self.byte[text]
        if (ids[inside] < 0).any():
            raise ValueError("a byte is not in the vocabulary")
        laid = np.zeros(len(ids), np.uint8)
        laid[inside] = text
        rank = self.byte_pairs[laid[:-1], laid[1:]]
        at = np.flatnonzero((rank >= 0) & inside[:-1] & inside[1:])
        rank = rank[at]
        order = np.argsort(rank, kind="stable")
        queue = RankQueue(self.size)
        each, first = np.unique(rank[order], return_index=True)
        at = at[order].tolist()
        for r, (a, b) in zip(each.tolist(), pairwise([*first.tolist(), len(at)]), strict=True):
            queue.open(r, at[a:b])
        return queue

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word, all merged through one queue.

        A bucket with many positions is merged side by side, a small one in turn. Of a
        token that can take part in a merge of lower rank, which would go first, side
        by side means the leftmost of each word; the others wait in the queue.
        """
        if not words:
            return []
        fences = np.cumsum([len(w) + 1 for w in words]) - 1
        n = int(fences[-1]) + 1
        # One memory seen twice: item by item and as a whole.
        ids, right, left = (array("q", bytes(8 * n)) for _ in range(3))
        all_ids, all_right, all_left = (np.frombuffer(a, np.int64) for a in (ids, right, left))
        all_right[:] = np.arange(1, n + 1)
        all_left[:] = np.arange(-1, n - 1)  # -1 is the last fence
        chosen = np.zeros(n, bool)
        queue = self._queue(words, all_ids, fences)
        waiting = queue.buckets.get
        size, known = self.size, self.pair_rank.get

        def side_by_side(rank: int, positions: list[int]) -> bool:
            """Merges the positions, unless some overlap or too few could go at once."""
            i = np.array(positions, np.int64)
            i = i[np.append(True, i[1:] != i[:-1]) & (all_ids[i] >= 0)]
            j = all_right[i]
            ready = self._ranks(all_ids[i], all_ids[j]) == rank
            i, j = i[ready], j[ready]
            if rank in self.sinking:
                word = np.searchsorted(fences, i)
                leftmost = np.append(True, word[1:] != word[:-1])[: len(i)]
                if 2 * np.count_nonzero(leftmost) < len(i):
                    return False
                if not leftmost.all():
                    queue.open(rank, i[~leftmost].tolist())
                i, j = i[leftmost], j[leftmost]
            chosen[i] = True
            overlap = chosen[j].any()
            chosen[i] = False
            if overlap:
                return False
            after = all_right[j]
            all_ids[i] = rank
            all_ids[j] = -2
            all_right[i] = after
            all_left[after] = i
            before = all_left[i]
            merged = np.full(len(i), rank)
            new = np.concatenate(
                (self._ranks(merged, all_ids[after]), self._ranks(all_ids[before], merged))
            )
            at = np.concatenate((i, before))
            up = new >= 0
            for r, p in zip(new[up].tolist(), at[up].tolist(), strict=True):
                if (bucket := waiting(r)) is None:
                    queue.open(r, [p])
                else:
                    bucket.append(p)
            return True

        while queue.top:
            rank, positions = queue.pop()
            if len(positions) >= WIDE and side_by_side(rank, positions):
                continue
            lower = False
            for k, i in enumerate(positions):
                if lower:  # a merge of lower rank came up and goes first
                    for later in positions[k:]:
                        queue.push(rank, later)
                    break
                a = ids[i]
                j = right[i]
                if a < 0 or (b := ids[j]) < 0 or known(a * size + b) != rank:
                    continue  # stale
                ids[i] = rank
                after = right[j]
                ids[j] = -2
                right[i] = after
                left[after] = i
                if (b := ids[after]) >= 0 and (new := known(rank * size + b)) is not None:
                    if (bucket := waiting(new)) is None:
                        queue.open(new, [i])
                    else:
                        bucket.append(i)
                    lower |= new < rank
                before = left[i]
                if (b := ids[before]) >= 0 and (new := known(b * size + rank)) is not None:
                    if (bucket := waiting(new)) is None:
                        queue.open(new, [before])
                    else:
                        bucket.append(before)
                    lower |= new < rank
        kept = all_ids >= 0
        ends = np.cumsum(kept)[fences].tolist()
        ids = all_ids[kept].astype(np.int32)
        return [ids[a:b] for a, b in pairwise([0, *ends])]

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        seen = self.seen
        words, ends = split(texts, "tiktoken")
        if len(seen) > REMEMBERED:
            seen.clear()
        seen[FENCE] = b""
        fresh = set(words) - seen.keys()
        queued = []
        for word in fresh:
            whole = self.ranks.get(raw := word.encode())
            if whole is None:
                queued.append((word, raw))
            else:
                seen[word] = np.int32(whole).tobytes()
        for (word, _), ids in zip(queued, self.merge([r for _, r in queued]), strict=True):
            seen[word] = ids.tobytes()
        ids = list(map(seen.__getitem__, words))
        return [b"".join(ids[a:b]) for a, b in pairwise([0, *ends.tolist()])]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed([text])[0], np.int32).tolist()

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids laid end to end."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[ids] - ends + lengths, lengths)
        return self.alphabet[shift + np.arange(len(shift))]


@lru_cache(2)
def codec(ranks_path: str) -> Codec:
    return Codec(read_ranks(ranks_path))


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id and the array of token ids of every text."""
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks_path)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                packed = bpe.packed(part.column(1).to_pylist())
                ends = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(packed), np.int32))
                ids = pa.ListArray.from_arrays(pa.array(ends), values)
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[id_col, "ids"])

    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return texts.mapInArrow(run, schema)


def decode_ids(
    encoded: DataFrame, ranks_path: str, ids_col: str = "ids", to: str = "decoded"
) -> DataFrame:
    """``encoded`` with the bytes its ids stand for, in place of a column of that name."""
    kept = [c for c in encoded.columns if c != to]
    encoded = encoded.select(*kept)
    schema = T.StructType([*encoded.schema.fields, T.StructField(to, T.BinaryType())])
    at = kept.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks_path)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                lists = part.column(at)
                raw = []
                for ids in lists:
                    values = ids.values
                    raw.append(
                        bpe.decode(values.to_numpy(zero_copy_only=False)).tobytes()
                        if values is not None and len(values)
                        else b""
                    )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(raw, pa.binary())], names=schema.names
                )

    return encoded.mapInArrow(run, schema)
