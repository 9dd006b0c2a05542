"""Language identification by the nearest of several centroids per language.

A text is the vector of its letter n-grams (one to three letters in lower case, word edges
included), hashed into ``BINS``: logarithms of counts times inverse document frequency, at length one.
Each language's sample is clustered by spherical k-means; a text gets the language of the centroid with
the greatest cosine. Each centroid knows how near its own members lie: a text farther from it
than nearly all of them is rejected, which tells other languages and noise from the known.

Only the fit uses a sample: of each language at most ``SAMPLE`` different texts, those that hash
lowest in each of as many hash buckets, and at most ``MOST_LANGS`` languages, the most common ones.
Vectors, frequencies and clusters are computed by Spark tasks, one language at a time; the driver holds
the centroids (``MOST_LANGS`` x ``CLUSTERS`` x ``BINS`` numbers of four bytes at most).

Null and empty texts and those without a letter are ``und`` with score 0, as is every text if nothing can
be learnt. Rows without an id or a language are not learnt from, rows without an id are not held out. Repeated
rows get equal predictions and are learnt once. Long texts are read in parts, whole. An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.llm.common import slices, stored, whole_text

BITS = 13
BINS = 1 << BITS
SAMPLE = 1_500
MOST_LANGS = 400
CLUSTERS = 4
ROUNDS = 12
FARTHEST = 0.01  # share of a centroid's members that its own floor would reject
FEW = 50  # members from which a centroid has a floor of its own, not its language's
SLICE_BYTES = 1 << 19
SLICE_DOCS = 256
UNKNOWN = "und"


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept out of the fit."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


@lru_cache(1)
def letters() -> np.ndarray:
    """Every code point's small letter, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def _bins(codes: np.ndarray, skip: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all n-grams that end at ``skip`` or later, and where each ends."""
    one = codes.astype(np.uint64)
    two = one.copy()
    two[1:] += one[:-1] << np.uint64(21)
    three = two.copy()
    three[2:] += one[:-2] << np.uint64(42)
    at = np.arange(len(codes))
    is_letter = codes > 0
    inner = np.zeros(len(codes), bool)
    inner[2:] = is_letter[1:-1]
    kinds = ((one, is_letter, 1), (two, at >= 1, 2), (three, inner, 3))
    found, ends = [], []
    for gram, wanted, kind in kinds:
        own = np.flatnonzero(wanted & (at >= skip))
        mixed = (gram[own] * np.uint64(4) + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        found.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
        ends.append(own)
    return np.concatenate(found), np.concatenate(ends)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_counts(texts: list[str]) -> np.ndarray:
    """A row of n-gram counts for each text; without letters, zeros."""
    if len(texts) == 1 and len(texts[0]) > SLICE_BYTES:
        return _long_counts(texts[0])
    sizes = np.array([len(t) + 1 for t in texts])
    codes = letters()[_points("\n".join(texts) + "\n")]
    owner = np.repeat(np.arange(len(texts)), sizes)
    # Of each run of other characters one stays; a word edge comes before the first letter.
    stays = np.flatnonzero((codes > 0) | (np.append(0, codes[:-1]) > 0))
    bins, ends = _bins(np.append(np.uint32(0), codes[stays]), 1)
    cell = owner[stays[ends - 1]] * BINS + bins
    return np.bincount(cell, minlength=len(texts) * BINS).reshape(len(texts), BINS)


def _long_counts(text: str) -> np.ndarray:
    total, before = np.zeros(BINS, np.int64), np.zeros(2, np.uint32)
    for at in range(0, len(text) + 1, SLICE_BYTES):
        part = text[at : at + SLICE_BYTES]
        if at + SLICE_BYTES > len(text):
            part += "\n"
        codes = letters()[_points(part)]
        codes = codes[(codes > 0) | (np.append(before[-1], codes[:-1]) > 0)]
        whole = np.append(before, codes)
        total += np.bincount(_bins(whole, 2)[0], minlength=BINS)
        before = whole[-2:]
    return total[None]


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weighted rows of length one, or of zeros."""
    weighted = np.log1p(counts).astype(np.float32) * idf
    norm = np.sqrt((weighted**2).sum(1, keepdims=True))
    return np.divide(weighted, norm, out=weighted, where=norm > 0)


def _blocks(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, at, SLICE_BYTES):
        for first in range(0, part.num_rows, SLICE_DOCS):
            yield part.slice(first, SLICE_DOCS)


def training_rows(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE, most_langs: int = MOST_LANGS
) -> DataFrame:
    """lang, text of the sampled rows outside the held-out third, different texts only."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), whole_text(text_col).alias("text")
    )
    rows = rows.withColumn("h", F.xxhash64("text"))
    langs = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_langs).select("lang")
    bucket = F.pmod(F.col("h"), F.lit(sample))
    chosen = (
        rows.join(F.broadcast(langs), "lang", "left_semi")  # ``most_langs`` rows
        .groupBy("lang", bucket.alias("bucket"))
        .agg(F.min(F.struct("h", "id")).alias("least"))
        .select(F.col("lang").alias("__lang"), F.col("least.h").alias("__h"), F.col("least.id").alias("__id"))
    )
    same = (F.col("lang") == F.col("__lang")) & (F.col("h") == F.col("__h")) & (F.col("id") == F.col("__id"))
    # ``most_langs`` x ``sample`` rows of three values at most
    return rows.join(F.broadcast(chosen), same, "left_semi").dropDuplicates(["lang", "h"]).select("lang", "text")


def _sampled_counts(rows: DataFrame) -> DataFrame:
    """lang and, of every sampled text with a letter, its bins and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch, 1):
                counts = gram_counts(part.column(1).to_pylist())
                row, column = np.nonzero(counts)
                cuts = np.searchsorted(row, np.arange(1, len(counts)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.split(column.astype(np.int32), cuts), pa.list_(pa.int32())),
                        pa.array(np.split(counts[row, column].astype(np.int32), cuts), pa.list_(pa.int32())),
                    ],
                    names=["lang", "bins", "counts"],
                )

    layout = "lang string, bins array<int>, counts array<int>"
    return rows.mapInArrow(run, layout).where(F.size("bins") > 0)


def spherical_centroids(rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length one, and the centroid of each row; starts from rows drawn by their distance."""
    first = int((rows @ rows.mean(0)).argmax())
    chosen, near = [first], rows @ rows[first]
    rng = np.random.Generator(np.random.PCG64(len(rows)))
    while len(chosen) < min(k, len(rows)):
        away = np.maximum(1 - near.astype(np.float64), 0) ** 2
        if away.sum() < 1e-9:
            break
        chosen.append(int(rng.choice(len(rows), p=away / away.sum())))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    centroids = rows[chosen]
    for _ in range(ROUNDS):
        member = (rows @ centroids.T).argmax(1)
        sums = np.stack([rows[member == c].sum(0) for c in range(len(centroids))])
        norm = np.sqrt((sums**2).sum(1, keepdims=True))
        centroids = np.where(norm > 0, sums / np.maximum(norm, 1e-12), centroids).astype(np.float32)
    return centroids, (rows @ centroids.T).argmax(1)


class Model:
    """Centroids in order of their languages."""

    def __init__(self, langs: list[str], centroids: np.ndarray, floors: np.ndarray, idf: np.ndarray):
        self.langs, self.centroids, self.floors, self.idf = langs, centroids, floors, idf

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether the text is too far from the nearest centroid."""
        counts = gram_counts(texts)
        found, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        far = np.ones(len(texts), bool)
        if self.langs:
            cosine = vectors(counts, self.idf) @ self.centroids.T
            best = cosine.argmax(1)
            known = counts.any(1)
            scores = np.where(known, np.clip(cosine.max(1), 0, 1), 0.0).astype(np.float64)
            far = ~known | (scores < self.floors[best])
            found = [self.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return found, scores, far


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
    clusters: int = CLUSTERS,
    most_langs: int = MOST_LANGS,
) -> Model:
    """The centroids learnt from the rows that are not held out."""
    rows = training_rows(docs, id_col, text_col, lang_col, sample, most_langs)
    counted = stored(_sampled_counts(rows), "language-sample")
    n = counted.count()
    seen = counted.select(F.explode("bins").alias("bin")).groupBy("bin").count().collect()  # ``BINS`` rows
    held = np.zeros(BINS)
    held[[r["bin"] for r in seen]] = [r["count"] for r in seen]
    idf = (np.log((1 + n) / (1 + held)) + 1).astype(np.float32)

    def cluster(key: tuple, table: pa.Table) -> pa.Table:
        table = table.take(pa.array(_order(table)))
        counts = np.zeros((table.num_rows, BINS), np.float32)
        for i, (bins, times) in enumerate(zip(table["bins"], table["counts"], strict=True)):
            counts[i, bins.values.to_numpy()] = times.values.to_numpy()
        own = vectors(counts, idf)
        centroids, member = spherical_centroids(own, clusters)
        near = (own * centroids[member]).sum(1)
        some = np.unique(member)
        own_floor = [near[member == c] if (member == c).sum() >= FEW else near for c in some]
        floors = [float(np.quantile(n, FARTHEST)) for n in own_floor]
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()] * len(some)),
                "floor": pa.array(floors, pa.float64()),
                "centroid": pa.array([centroids[c].tobytes() for c in some], pa.binary()),
            }
        )

    found = counted.groupBy("lang").applyInArrow(cluster, "lang string, floor double, centroid binary").collect()
    found.sort(key=lambda r: (r["lang"], r["centroid"]))
    centroids = np.frombuffer(b"".join(r["centroid"] for r in found), np.float32).reshape(-1, BINS)
    return Model([r["lang"] for r in found], centroids, np.array([r["floor"] for r in found]), idf)


def _order(table: pa.Table) -> np.ndarray:
    """An order of sampled rows that does not hang on how they arrived."""
    keys = [(b.values.to_numpy().tobytes(), c.values.to_numpy().tobytes()) for b, c in zip(table["bins"], table["counts"], strict=True)]
    return np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, nearest language, score, rejected, and ``language``: the nearest or, if rejected, ``und``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by ``MOST_LANGS``

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in _blocks(batch, 1):
                found, scores, far = model.predict(part.column(1).to_pylist())
                told = [UNKNOWN if f else lang for lang, f in zip(found, far, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found), pa.array(scores), pa.array(far), pa.array(told)],
                    names=[id_col, "nearest", "score", "rejected", "language"],
                )

    schema = T.StructType(
        [
            docs.schema[id_col],
            T.StructField("nearest", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
            T.StructField("language", T.StringType()),
        ]
    )
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return texts.mapInArrow(run, schema)
