"""Cutting documents into pieces and packing them by bounded-space best fit.

A document is its token ids and an end id. Only a document longer than a sequence
is cut; its first piece takes the odd length and the others are whole sequences.

Pieces are dealt to buckets by a hash of all their columns, each packed on its own. Equal pieces of a
partition are counted, and all but the first are dealt by their count and partition, so that neither a missing
nor a repeated id fills a bucket. Counts of equal pieces don't hang on their order, so a retried task deals alike. A bucket takes its
pieces longest first and puts each into the open bin it fills best. Open bins are
lists keyed by free space; a bitset over free space finds the best fit with one shift
and one find-first-set. There is a fixed number of open bins; when another is needed, the
fullest closes first. What is left open at the end of a bucket is its only
waste besides closed gaps, so buckets hold thousands of pieces.

Null text is the empty text: one piece holding the end id. Repeated rows are packed
as often as they occur. An empty table gives an empty result; other columns
are not read by ``token_pieces`` and are carried along by ``pack``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from feedsieve.llm.byte_level import PATTERN, ranks_of_json
from feedsieve.llm.common import corpus_size, slices, whole_text
from feedsieve.llm.pretokens import disputed

BUCKET_PIECES = 8192
OPEN_BINS = 4096


@lru_cache(2)
def encoder(tokenizer_json: str) -> Callable[[str], np.ndarray]:
    """Ids as the file's own library gives them, by a library several times as fast.

    Texts with a character that the two class differently go to the file's own.
    """
    ranks, special = ranks_of_json(tokenizer_json)
    fast = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    own = Tokenizer.from_file(tokenizer_json)
    in_dispute = regex.compile(f"[{regex.escape(disputed())}]").search if disputed() else None

    def encode(text: str) -> np.ndarray:
        if in_dispute and not text.isascii() and in_dispute(text):
            return np.array(own.encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text, allowed_special="all")

    return encode


def token_pieces(
    docs: DataFrame,
    tokenizer_json: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    with_copies: bool = False,
) -> DataFrame:
    """id, piece, start, length, ids_crc32 and, if asked, ids of every piece.

    With copies, ``__copy`` tells how many equal pieces came before in the partition.
    """
    fields = [
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    if with_copies:
        fields.append(T.StructField("__copy", T.LongType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_json)
        seen: dict[int, int] = {}
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                row, piece, start, length, crc, kept = [], [], [], [], [], []
                for i, text in enumerate(part.column(1)):
                    ids = np.append(encode(text.as_py()), end_id).astype("<u4")
                    n = len(ids)
                    first = n % capacity or capacity if n > capacity else n
                    edges = [0, *range(first, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                        row.append(i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b]))
                        if with_ids:
                            kept.append(ids[a:b].astype(np.int32))
                columns = [
                    part.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(c, pa.int64()) for c in (start, length, crc)),
                ]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                if with_copies:
                    owners = part.column(0).to_pylist()
                    same = zip((owners[i] for i in row), piece, start, length, crc, strict=True)
                    columns.append(pa.array([_before(seen, hash(one)) for one in same], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return texts.mapInArrow(cut, T.StructType(fields))


def best_fit(lengths: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, taken in the given order."""
    bins, offsets = [], []
    at_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = n_open = made = 0
    for need in lengths:
        fits = mask >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            chosen = at_free[free].pop()
            if not at_free[free]:
                mask ^= 1 << free
            n_open -= 1
        else:
            if n_open == open_bins:
                fullest = (mask & -mask).bit_length() - 1
                at_free[fullest].pop()
                if not at_free[fullest]:
                    mask ^= 1 << fullest
                n_open -= 1
            free, chosen = capacity, made
            made += 1
        bins.append(chosen)
        offsets.append(capacity - free)
        left = free - need
        if left:
            at_free[left].append(chosen)
            mask |= 1 << left
            n_open += 1
    return bins, offsets


def _before(seen: dict[int, int], own: int) -> int:
    """How often ``own`` was seen before."""
    before = seen.get(own, 0)
    seen[own] = before + 1
    return before


def _count_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with ``__copy``: how many equal pieces came before in the partition."""
    seen: dict[int, int] = {}
    for batch in batches:
        copies = [_before(seen, own) for own in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(copies, pa.int64())], names=[*batch.schema.names, "__copy"]
        )


def pack(
    pieces: DataFrame,
    n_buckets: int,
    capacity: int = 1024,
    open_bins: int = OPEN_BINS,
    id_col: str = "doc_id",
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; lengths are 1 to ``capacity``.

    ``__copy`` (see ``token_pieces``) is counted here, in a map of its own, if the pieces lack it.
    """
    plain = pieces.drop("sequence_id", "offset", "__copy")
    own = F.xxhash64(*[F.col(c) for c in (id_col, "piece", "start", "length", "ids_crc32")])
    counted = pieces.drop("sequence_id", "offset").withColumn("__own", own)
    if "__copy" not in pieces.columns:
        counted = counted.mapInArrow(
            _count_copies, T.StructType([*counted.schema.fields, T.StructField("__copy", T.LongType())])
        )
    salt = F.xxhash64("__own", "__copy", F.spark_partition_id())
    dealt = (
        counted.withColumn(
            "__bucket",
            F.pmod(F.when(F.col("__copy") == 0, F.col("__own")).otherwise(salt), F.lit(n_buckets)),
        )
        .drop("__own", "__copy")
    )
    schema = T.StructType(
        [*plain.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def fill(key: tuple, table: pa.Table) -> pa.Table:
        table = table.drop_columns(["__bucket"])
        longest_first = [("length", "descending"), (id_col, "ascending"), ("piece", "ascending")]
        table = table.take(pc.sort_indices(table, sort_keys=longest_first))
        bins, offsets = best_fit(table.column("length").to_pylist(), capacity, open_bins)
        first = key[0].as_py() << 32
        return table.append_column(
            "sequence_id", pa.array(np.asarray(bins, np.int64) + first)
        ).append_column("offset", pa.array(offsets, pa.int64()))

    return dealt.groupBy("__bucket").applyInArrow(fill, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_json: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_pieces: int = BUCKET_PIECES,
) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    rows, size = corpus_size(docs, text_col)
    # A piece more than the document's first takes a whole sequence, so this many at most.
    n_buckets = max(1, math.ceil((rows + size / capacity) / bucket_pieces))
    pieces = token_pieces(docs, tokenizer_json, capacity, end_id, id_col, text_col, with_copies=True)
    return pack(pieces, n_buckets, capacity, OPEN_BINS, id_col)
