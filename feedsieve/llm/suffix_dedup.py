"""Removal of byte strings that repeat anywhere in the corpus, by sorted suffixes.

Every window of ``length`` bytes is given an anchor: the place in it whose next ``GRAM``
bytes hash lowest. Equal windows have their anchors at the same offset, so only suffixes at
anchors need sorting, about one in eighty. The windows of one anchor lie next
to each other; the bytes they cover are its segment.

1. Anchors whose gram occurs once in the corpus repeat nowhere and are done.
2. Anchors that share gram and whole segment repeat with all their windows.
3. Where a gram has different segments, their suffixes are sorted deep-shallow,
   to the right from the anchor and, reversed, to the left. The common prefixes of sorted
   neighbours tell for each offset which windows are equal: those that agree with another
   segment on as many bytes as needed on both sides. Segments are compared
   byte by byte.

Grams and segments are told apart by 64-bit hashes that must agree together, and counted
with map-side combining. Groups of a gram hold one copy of each segment; a gram with
more than ``GIANT`` anchors is split by the windows themselves. The text is shuffled once,
for reading segments and for removing bytes.

Null text is the empty text. A row is known by its id and a hash of its text; repeated rows
repeat each other and lose all their windows, however many there are. Texts below
``length`` bytes stay as they are. An empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.llm.common import slices, stored, whole_text
from feedsieve.llm.deep_shallow import common_prefix, deep_shallow_order

LENGTH = 200
GRAM = 32
SHALLOW = GRAM + 16
FEW = 12
GIANT = 50_000
SLICE_BYTES = 1 << 19
PART = 1 << 18  # windows looked at together


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place, by doubling."""
    hashes = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    width = 1
    while width < GRAM:
        hashes = hashes[:-width] * np.uint64(0xD6E8FEB86659FD93) + hashes[width:]
        hashes ^= hashes >> np.uint64(31)
        width *= 2
    hashes *= np.uint64(0x2545F4914F6CDD1D)
    return hashes ^ (hashes >> np.uint64(32))


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each ``width`` in a row, by running minima over blocks."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class Anchors:
    """Anchors of many texts laid end to end."""

    def __init__(self, texts: list[bytes], length: int = LENGTH):
        self.joined = b"".join(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(sizes) - sizes
        none = np.zeros(0, np.int64)
        self.text = self.first = self.last = self.place = self.gram = none
        if len(self.joined) < length:
            return
        raw, ends = np.frombuffer(self.joined, np.uint8), starts + sizes
        found = []
        for at in range(0, len(raw) - length + 1, PART):
            # Windows of texts laid end to end; only those inside their text count.
            window = np.arange(at, min(at + PART, len(raw) - length + 1))
            owner = np.searchsorted(ends, window, "right")
            stays = window + length <= ends[owner]
            if not stays.any():
                continue
            hashes = gram_hashes(raw[at : window[-1] + length])
            low = np.uint64(0xFFFFFFFF)
            # Ordered by half the hash, then from the left.
            keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
            place = (sliding_least(keys, length - GRAM + 1) & low).astype(np.int64)[stays]
            window, owner = window[stays], owner[stays]
            new = np.concatenate(([True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])))
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(window)) - 1
            found.append((owner[begin], window[begin], window[end], place[begin] + at, hashes[place[begin]]))
        if not found:
            return
        owner, first, last, place, gram = (np.concatenate(c) for c in zip(*found, strict=True))
        # An anchor may go on from one part to the next.
        new = np.concatenate(([True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])))
        begin = np.flatnonzero(new)
        self.text, self.first, self.place = owner[begin], first[begin], place[begin]
        self.last = last[np.append(begin[1:], len(last)) - 1]
        self.gram = gram[begin].view(np.int64)
        self.start = starts[self.text]

    def segments(self, length: int = LENGTH) -> np.ndarray:
        """Hash of each anchor's segment and of where the anchor lies in it."""
        view, digest = memoryview(self.joined), xxhash.xxh3_64_intdigest
        found = np.fromiter(
            (
                digest(view[a:b], seed)
                for a, b, seed in zip(
                    self.first.tolist(),
                    (self.last + length).tolist(),
                    (self.place - self.first).tolist(),
                    strict=True,
                )
            ),
            np.uint64,
            len(self.first),
        )
        return found.view(np.int64)


def packed_place(place: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place in the text, and how far before it the first and the last window begin."""
    return place << 16 | (place - first) << 8 | (place - last)


def equal_offsets(
    left: list[bytes], right: list[bytes], length: int = LENGTH
) -> list[list[tuple[int, int]]]:
    """For each segment, the ranges of offsets whose windows another segment has too.

    ``left`` is read backwards from the anchor. A window at offset d has d bytes on the
    left and ``length - d`` on the right.
    """
    n = len(right)
    order, common = deep_shallow_order(right, SHALLOW)
    found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    if n <= FEW:
        for i in range(n):
            ahead = length
            for j in range(i + 1, n):
                ahead = min(ahead, common[j])
                a, b = order[i], order[j]
                low, high = length - ahead, common_prefix(left[a], left[b])
                if low <= high:
                    found[a].append((low, high))
                    found[b].append((low, high))
        return found
    left_order, left_common = deep_shallow_order(left, SHALLOW)
    ahead, back = np.array(common), np.array(left_common)
    right_size, left_size = np.array([len(r) for r in right]), np.array([len(x) for x in left])
    right_at, left_at = np.array(order), np.array(left_order)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(length - int(right_size.max()), int(left_size.max()) + 1):
        right_class[right_at] = np.cumsum(ahead < length - d)
        left_class[left_at] = np.cumsum(back < d)
        has = np.flatnonzero((right_size >= length - d) & (left_size >= d))
        if len(has) < 2:
            continue
        key = right_class[has] * (n + 1) + left_class[has]
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        for a in has[counts[inverse] > 1].tolist():
            if found[a] and found[a][-1][1] == d - 1:
                found[a][-1] = (found[a][-1][0], d)
            else:
                found[a].append((d, d))
    return found


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole_text(text_col)
    return docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.encode(text, "UTF-8").alias("raw")
    )


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for part in slices(batch, batch.schema.get_field_index("raw"), SLICE_BYTES):
        yield part, part.column("raw").to_pylist()


def repeated_spans(docs: DataFrame, length: int = LENGTH, giant: int = GIANT) -> DataFrame:
    """id, th and spans (start, end) of repeated windows; ``docs`` has id, th and raw."""
    id_type = docs.schema["id"].dataType
    found_in = T.StructType(
        [T.StructField("id", id_type), *(T.StructField(c, T.LongType()) for c in ("th", "gram", "seg", "at"))]
    )

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _slices(batch):
                a = Anchors(texts, length)
                if len(a.text):
                    rows = pa.array(a.text)
                    at = packed_place(a.place - a.start, a.first - a.start, a.last - a.start)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("id").take(rows),
                            part.column("th").take(rows),
                            *(pa.array(c) for c in (a.gram, a.segments(length), at)),
                        ],
                        names=found_in.names,
                    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                raw = batch.column("raw")[row].as_py()
                asked = batch.column("asked")[row].as_py()
                left, right = [], []
                for one in asked:
                    place, before, after = one["at"] >> 16, one["at"] >> 8 & 255, one["at"] & 255
                    left.append(raw[place - before : place][::-1])
                    right.append(raw[place : place - after + length])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([one[c] for one in asked], kind)
                        for c, kind in (("gram", pa.int64()), ("seg", pa.int64()), ("copies", pa.int64()), ("large", pa.bool_()))
                    ]
                    + [pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                    names=["gram", "seg", "copies", "large", "left", "right"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by gram: one group at a time, which may go on in the next batch."""
        group: list[tuple] = []

        def closed() -> Iterator[tuple]:
            if len(group) < 2:
                return
            ranges = equal_offsets([g[2] for g in group], [g[3] for g in group], length)
            for (gram, seg, _, _), own in zip(group, ranges, strict=True):
                for low, high in own:
                    yield gram, seg, low, high

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 2 + [pa.int32()] * 2, strict=True)],
                names=["gram", "seg", "low", "high"],
            )

        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "seg", "left", "right")), strict=True):
                if group and group[0][0] != row[0]:
                    out.extend(closed())
                    group.clear()
                group.append(row)
            if out:
                yield batch_of(out)
        if out := list(closed()):
            yield batch_of(out)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                gram, seg = batch.column("gram")[row].as_py(), batch.column("seg")[row].as_py()
                left, right = batch.column("left")[row].as_py(), batch.column("right")[row].as_py()
                whole = left[::-1] + right
                offsets = list(range(length - len(right), len(left) + 1))
                digests = [
                    hashlib.blake2b(whole[len(left) - d : len(left) - d + length], digest_size=16).digest()
                    for d in offsets
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([gram] * len(offsets)),
                        pa.array([seg] * len(offsets)),
                        pa.array(offsets, pa.int32()),
                        pa.array(digests, pa.binary()),
                    ],
                    names=["gram", "seg", "low", "window"],
                )

    rows = docs.mapInArrow(anchors, found_in)
    grams = (
        rows.groupBy("gram")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("seg").alias("least"),
            F.max("seg").alias("most"),
        )
        .where("n > 1")
        .select("gram", (F.col("least") != F.col("most")).alias("mixed"), (F.col("n") > giant).alias("large"))
    )
    # Read several times from here on.
    shared = stored(rows.join(grams, "gram"), "anchors")
    # One copy of each segment of the grams that have several.
    kinds = (
        shared.where("mixed")
        .groupBy("gram", "seg", "large")
        .agg(F.min(F.struct("id", "th", "at")).alias("one"), F.count(F.lit(1)).alias("copies"))
    )
    asked = (
        kinds.select("one.id", "one.th", F.struct("gram", "seg", "copies", "large", "one.at").alias("ask"))
        .groupBy("id", "th")
        .agg(F.collect_list("ask").alias("asked"))
    )
    texts = docs.select("id", "th", "raw")
    same_row = (F.col("d.th") == F.col("k.th")) & F.col("d.id").eqNullSafe(F.col("k.id"))
    cut = (
        texts.alias("d")
        .join(asked.alias("k"), same_row)
        .select("raw", "asked")
        .mapInArrow(segments, "gram long, seg long, copies long, large boolean, left binary, right binary")
    )
    ordinary = (
        cut.where("NOT large")
        .select("gram", "seg", "left", "right")
        .repartition("gram")
        .sortWithinPartitions("gram", "seg")
        .mapInArrow(compare, "gram long, seg long, low int, high int")
    )
    if not shared.where("mixed AND large").isEmpty():
        exploded = cut.where("large").select("gram", "seg", "left", "right").mapInArrow(
            windows, "gram long, seg long, low int, window binary"
        )
        twice = exploded.groupBy("window").agg(F.min("seg").alias("a"), F.max("seg").alias("b"))
        ordinary = ordinary.unionByName(
            exploded.join(twice.where("a <> b"), "window", "left_semi").select(
                "gram", "seg", "low", F.col("low").alias("high")
            )
        )
    offsets = ordinary.groupBy("gram", "seg").agg(
        F.collect_list(F.struct("low", "high")).alias("ranges")
    )
    copied = kinds.where("copies > 1").select("gram", "seg", F.lit(True).alias("copied"))
    place = F.shiftright("at", 16)
    before, after = F.shiftright("at", 8).bitwiseAND(F.lit(255)), F.col("at").bitwiseAND(F.lit(255))
    whole = F.array(F.struct(after.cast("int").alias("low"), before.cast("int").alias("high")))
    alike = shared.where("NOT mixed").select("id", "th", "at", whole.alias("ranges"))
    differing = (
        shared.where("mixed")
        .join(copied, ["gram", "seg"], "left")
        .join(offsets, ["gram", "seg"], "left")
        .select("id", "th", "at", F.when(F.col("copied"), whole).otherwise(F.col("ranges")).alias("ranges"))
        .where("ranges IS NOT NULL")
    )
    return (
        alike.unionByName(differing)
        .select("id", "th", place.alias("place"), F.explode("ranges").alias("r"))
        .groupBy("id", "th")
        .agg(
            F.collect_list(
                F.struct(
                    (F.col("place") - F.col("r.high")).alias("start"),
                    (F.col("place") - F.col("r.low") + length).alias("end"),
                )
            ).alias("spans")
        )
    )


def kept_bytes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, int]:
    """What lies outside all spans, and the number of maximal runs inside."""
    change = np.zeros(len(raw) + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    inside = np.cumsum(change[:-1]) > 0
    runs = int(inside[0]) + int((inside[1:] & ~inside[:-1]).sum()) if len(raw) else 0
    return np.frombuffer(raw, np.uint8)[~inside].tobytes(), runs


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    giant: int = GIANT,
    also: list[str] | None = None,
    as_text: bool = False,
) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept, and the columns named in ``also``, each after two underscores.

    ``kept`` is bytes, or text without the characters that a cut went through.
    """
    if not GRAM <= length <= GRAM + 255:
        raise ValueError(f"length is {GRAM} to {GRAM + 255}")
    keyed = _keyed(docs, id_col, text_col)
    spans = repeated_spans(keyed, length, giant)
    carried = also or []
    own = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(whole_text(text_col)).alias("th"),
        F.encode(whole_text(text_col), "UTF-8").alias("raw"),
        *(F.col(c).alias(f"__{c}") for c in carried),
    )
    same_row = (F.col("d.th") == F.col("s.th")) & F.col("d.id").eqNullSafe(F.col("s.id"))
    joined = own.alias("d").join(spans.alias("s"), same_row, "left").select(
        "d.id", "raw", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"),
        *(f"__{c}" for c in carried),
    )
    # Under private names: an input column may be called like one of the results.
    extra = [T.StructField(f"__{c}", docs.schema[c].dataType) for c in carried]
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
            T.StructField("kept", T.StringType() if as_text else T.BinaryType()),
            *extra,
        ]
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _slices(batch):
                kept, runs = [], []
                for raw, starts, ends in zip(texts, part.column("starts"), part.column("ends"), strict=True):
                    if starts.is_valid and len(starts):
                        left, n = kept_bytes(
                            raw, starts.values.to_numpy(zero_copy_only=False), ends.values.to_numpy(zero_copy_only=False)
                        )
                    else:
                        left, n = raw, 0
                    kept.append(left)
                    runs.append(n)
                size = np.array([len(t) for t in texts], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(size),
                        pa.array(size - np.array([len(k) for k in kept], np.int64)),
                        pa.array(runs, pa.int64()),
                        pa.array([k.decode(errors="ignore") for k in kept], pa.string())
                        if as_text
                        else pa.array(kept, pa.binary()),
                        *(part.column(f"__{c}") for c in carried),
                    ],
                    names=schema.names,
                )

    return joined.mapInArrow(remove, schema)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the text that is left, and its length where they have one."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    left = remove_repeats(docs, length, also=[*others], as_text=True)
    renewed = {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in others:
        renewed["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return left.select(*((renewed[c] if c in renewed else F.col(f"`__{c}`")).alias(c) for c in docs.columns))
