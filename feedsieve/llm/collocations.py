"""Phrase collocations: contiguous phrases that recur more often than their parts suggest.

Level by level, candidates of k words are laid out as a double-array trie, broadcast, and
walked from every position of a block of text at once; the accepting states are counted with
``bincount`` and the counts of all shards of the corpus are summed.

1. Words are counted per language. Those that occur ``support`` times are numbered across
   languages, by a trie over their bytes, and texts become numbers: 0 stands for any rarer
   word and for the end of a piece, since no phrase passes either.
2. A window of k + 1 words can only be frequent if both windows of k words in it are. Windows for which
   this holds are hashed into buckets of 64 bits and by a second hash of 32, and counted by a grouping with map-side
   combining; what stays below ``support`` is no frequent window. Each also keeps one task that wrote a text with it: only
   the texts of that task name it as a candidate. Of a bucket that holds several frequent windows all texts name theirs.
3. Numbers at which no candidate begins or passes are dropped from the text, so every level reads less.

Counts are whole and exact at every level; buckets only spare candidates. A trie holds ``MOST_KEYS`` keys
at most, 30 MB or so for phrases; with more candidates there are several tries, each broadcast on
its own and walked in a pass of its own. Buckets that reach the support are broadcast ``MOST_HOT`` at a time (16 bytes
each), also one lot to a pass. So passes, not memory, grow with the number of frequent phrases.

Scores are quotients of decimals without fraction, exact up to 38 digits.

Null text is the empty text, a null language ``und``. Repeated rows and rows without an id count like any
other. A text that is one long piece is read in parts and joined as numbers. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.llm.common import slices, stored, whole_text
from feedsieve.llm.double_array import DoubleArray, double_array

SUPPORT = 100
LONGEST = 5
TOP = 2_000
MOST_KEYS = 500_000
MOST_HOT = 2_000_000
SLICE_BYTES = 1 << 20
HELD_WORDS = 200_000
HELD_WINDOWS = 1 << 21
BLOCK = 1 << 16
SALTS = 16

# What ends a piece, and what parts words.
BREAKS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + BREAKS + b"\t", bytes(range(97, 123)) + b"\n" * len(BREAKS) + b" "
)
# The sign marks where a candidate begins; this bit, one found in the pass under way.
FOUND = np.int32(1 << 30)
NUMBER = np.int32((1 << 29) - 1)
PARTS = "ids binary, number long, block long, salt int, counts binary"


def _cut(raw: bytes) -> Iterator[bytes]:
    """Plain bytes in parts, cut between words."""
    at = 0
    while len(raw) - at > SLICE_BYTES:
        space, line = (raw.find(c, at + SLICE_BYTES) for c in (b" ", b"\n"))
        cut = min((c for c in (space, line) if c >= 0), default=len(raw))
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def word_counts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """lang, word, f; the empty word stands for all words of the language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> pa.RecordBatch:
            rows = [(lang, w, n) for lang, found in held.items() for w, n in found.items()]
            rows += [(lang, b"", found.total()) for lang, found in held.items()]
            held.clear()
            langs, words, counts = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(langs, pa.string()),
                    pa.array(words, pa.binary()).cast(pa.string()),
                    pa.array(counts, pa.int64()),
                ],
                names=["lang", "word", "f"],
            )

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                found = held.setdefault(lang.as_py(), Counter())
                for part in _cut(text.as_py().encode().translate(_PLAIN)):
                    found.update(part.split())
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield flush()
        yield flush()

    return (
        _texts(docs, lang_col, text_col)
        .mapInArrow(run, "lang string, word string, f long")
        .groupBy("lang", "word")
        .agg(F.sum("f").alias("f"))
    )


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), whole_text(text_col).alias("text"))


def _count_rows(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of one task, sent out as blocks; blocks of zeros are not."""
    salt = TaskContext.get().partitionId() % SALTS
    for at in range(0, len(counts), BLOCK):
        part = counts[at : at + BLOCK]
        if part.any():
            yield _row(None, None, at // BLOCK, salt, part.tobytes())


def _row(ids: bytes | None, number: int | None, block: int | None, salt: int | None, counts: bytes | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids], pa.binary()),
            pa.array([number], pa.int64()),
            pa.array([block], pa.int64()),
            pa.array([salt], pa.int32()),
            pa.array([counts], pa.binary()),
        ],
        names=["ids", "number", "block", "salt", "counts"],
    )


class _Numbers:
    """Numbers for the texts a task writes; a repeated task gives the same."""

    def __init__(self):
        self.next = TaskContext.get().partitionId() << 32

    def text(self, ids: bytes) -> pa.RecordBatch:
        self.next += 1
        return _row(ids, self.next, None, None, None)


def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """The counts of a trie's keys: the blocks of all tasks added up, in two rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for block, salt, counts in zip(*batch.columns, strict=True):
                key, part = (block.as_py(), salt.as_py()), np.frombuffer(counts.as_buffer(), np.int64)
                held[key] = held[key] + part if key in held else part
        for (block, salt), total in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([salt], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                names=["block", "salt", "counts"],
            )

    layout = "block long, salt int, counts binary"
    once = parts.select("block", "salt", "counts").repartition("block", "salt").mapInArrow(run, layout)
    whole = once.withColumn("salt", F.lit(0)).repartition("block").mapInArrow(run, layout)
    total = np.zeros(-(-size // BLOCK) * BLOCK, np.int64)
    for row in whole.collect():  # bounded by ``MOST_KEYS``
        part = np.frombuffer(row["counts"], np.int64)
        total[row["block"] * BLOCK :][: len(part)] = part
    return total[:size]


def _bucket(ids: np.ndarray, at: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Bucket of the window of ``width`` words at each place; another seed gives another hash."""
    mixed = np.full(len(at), seed, np.uint64)
    for k in range(width):
        mixed = (mixed + ids[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


DIGITS = (24, 16, 8, 0)  # a word number as symbols


def phrase_key(words: tuple[int, ...]) -> bytes:
    return b"".join(w.to_bytes(len(DIGITS), "big") for w in words)


def starts(marked: np.ndarray, width: int) -> np.ndarray:
    """Where a window of ``width`` words may begin: both windows one shorter are marked."""
    return np.flatnonzero(marked[:-1] & marked[1:]) if width > 1 else np.flatnonzero(marked)


def walk_phrases(
    trie: DoubleArray, ids: np.ndarray, at: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The places whose window is a key of the trie, and the key's value.

    All places advance together, a word at a time; those that fall out are dropped.
    """
    state = np.zeros(len(at), np.int32)
    for k in range(width):
        word = ids[at + k]
        for shift in DIGITS:
            state, there = trie.step(state, word >> shift & 255)
            at, state, word = at[there], state[there], word[there]
    return at, trie.value[state]


def word_places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Begin and end of each word, whether a piece ends before it, and after the last one."""
    inside = np.concatenate(([False], (raw != 32) & (raw != 10), [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, end = edges[::2], edges[1::2]
    lines = np.flatnonzero(raw == 10)
    before = np.searchsorted(lines, first)
    tail = len(lines) > (before[-1] if len(before) else 0)
    return first, end, np.diff(before, prepend=0) > 0, bool(tail)


def walk_words(
    trie: DoubleArray, raw: np.ndarray, first: np.ndarray, sizes: np.ndarray, state: np.ndarray
) -> np.ndarray:
    """The value of each word from its state of departure; 0 if it is no key."""
    found = np.zeros(len(first), np.int32)
    alive, depth = np.flatnonzero(state >= 0), 0
    state = state[alive]
    while len(alive):
        ended = sizes[alive] == depth
        found[alive[ended]] = trie.value[state[ended]]
        alive, state = alive[~ended], state[~ended]
        state, there = trie.step(state, raw[first[alive] + depth].astype(np.int32))
        alive, state = alive[there], state[there]
        depth += 1
    return found


def numbered(plain: bytes, ends: np.ndarray, roots: np.ndarray, trie: DoubleArray) -> np.ndarray:
    """Word numbers of texts laid end to end, 0 between pieces and for unknown words.

    ``ends`` are the ends of the texts, each after a line feed; ``roots`` their states of departure.
    """
    found, apart, at = [], False, 0
    for part in _cut(plain):
        raw = np.frombuffer(part, np.uint8)
        first, end, breaks, tail = word_places(raw)
        if len(first):
            breaks[0] |= apart
            owner = np.searchsorted(ends, first + at, "right")
            ids = np.zeros(len(first) + int(breaks.sum()), np.int32)
            ids[np.arange(len(first)) + np.cumsum(breaks)] = walk_words(
                trie, raw, first, end - first, roots[owner]
            )
            found.append(ids)
            apart = tail
        else:
            apart |= tail
        at += len(part)
    return np.concatenate([*found, np.zeros(1, np.int32)])


def passed_on(ids: np.ndarray, marked: np.ndarray, width: int) -> bytes | None:
    """What the next level needs of a text whose windows of ``width`` words are marked; nothing if it has no candidate."""
    wider = width + 1
    at = starts(marked, wider)
    if not len(at):
        return None
    edge = np.zeros(len(ids) + 1, np.int32)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + wider, -1)
    covered = np.cumsum(edge[:-1]) > 0
    left = np.where(marked, ids | np.int32(-(1 << 31)), ids)
    left[~covered] = 0
    covered[1:] |= covered[:-1]  # one zero stays between runs
    return left[covered].tobytes()


def _numbered_texts(
    spark: SparkSession, texts: DataFrame, tries: Iterator[tuple[DoubleArray, int]], n_tries: int
) -> DataFrame:
    """The texts as numbers of frequent words, by one pass for each trie."""
    between = "plain binary, ends binary, langs array<string>, ids binary"
    for turn, (trie, offset) in enumerate(tries):
        shared, is_last, is_first = spark.sparkContext.broadcast(trie), turn == n_tries - 1, turn == 0

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trie, roots, numbers = shared.value, {}, _Numbers()
            for batch in batches:
                for plain, ends, langs, before in _from_texts(batch) if is_first else _from_rows(batch):
                    for lang in set(langs) - roots.keys():
                        roots[lang] = trie.state_of(lang.encode() + b"\n")
                    own = np.array([roots[lang] for lang in langs], np.int32)
                    ids = numbered(plain, ends, own, trie)
                    ids = np.where(ids > 0, ids + np.int32(offset), 0 if before is None else before)
                    if not is_last:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([plain], pa.binary()),
                                pa.array([ends.tobytes()], pa.binary()),
                                pa.array([langs], pa.list_(pa.string())),
                                pa.array([ids.tobytes()], pa.binary()),
                            ],
                            names=["plain", "ends", "langs", "ids"],
                        )
                        continue
                    left = passed_on(ids, ids > 0, 1)
                    if left is not None:
                        yield numbers.text(left)

        texts = stored(texts.mapInArrow(run, PARTS if is_last else between), "numbered")
        shared.unpersist()
    return texts


def _from_texts(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray, list[str], None]]:
    for part in slices(batch, 1, SLICE_BYTES):
        raw = [t.encode().translate(_PLAIN) + b"\n" for t in part.column(1).to_pylist()]
        yield b"".join(raw), np.cumsum([len(r) for r in raw]), part.column(0).to_pylist(), None


def _from_rows(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray, list[str], np.ndarray]]:
    for row in batch.to_pylist():
        yield row["plain"], np.frombuffer(row["ends"], np.int64), row["langs"], np.frombuffer(row["ids"], np.int32)


def _hot_buckets(texts: DataFrame, width: int, support: int) -> DataFrame:
    """bucket, owner: those with a window that reaches the support, and the task whose texts name it; -1 for all.

    A row of counts is sent for nearly every window of the corpus: it holds both hashes, the count and the task, no more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            none = [np.zeros(0, np.int64)] * 3
            buckets, second, owners = (np.concatenate(c) for c in zip(none, *held, strict=True))
            held.clear()
            order = np.lexsort((owners, second, buckets))
            buckets, second, owners = buckets[order], second[order], owners[order]
            new = np.append(True, (buckets[1:] != buckets[:-1]) | (second[1:] != second[:-1]))[: len(buckets)]
            first = np.flatnonzero(new)
            counts = np.diff(np.append(first, len(buckets)))
            return pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (buckets[first], second[first], owners[first], counts.astype(np.int64))],
                names=["bucket", "second", "owner", "n"],
            )

        for batch in batches:
            for blob, number in zip(*batch.columns, strict=True):
                raw = np.frombuffer(blob.as_buffer(), np.int32)
                ids, at = raw & NUMBER, starts(raw < 0, width)
                second = _bucket(ids, at, width, 1) & 0xFFFFFFFF
                held.append((_bucket(ids, at, width), second, np.full(len(at), number.as_py() >> 32)))
                n += len(at)
                if n > HELD_WINDOWS:
                    yield flush()
                    n = 0
        yield flush()

    layout = "bucket long, second long, owner long, n long"
    counted = texts.where("ids IS NOT NULL").select("ids", "number").mapInArrow(run, layout)
    windows = counted.groupBy("bucket", "second").agg(F.sum("n").alias("n"), F.min("owner").alias("owner"))
    alone = F.when(F.count(F.lit(1)) == 1, F.min("owner")).otherwise(F.lit(-1).cast("long"))
    return windows.where(F.col("n") >= support).groupBy("bucket").agg(alone.alias("owner"))


def _candidates(texts: DataFrame, hot: pa.Table, width: int) -> DataFrame:
    """w1 to w``width``: the windows of the hot buckets (sorted), named by the texts of the task these keep."""
    shared = texts.sparkSession.sparkContext.broadcast((hot["bucket"].to_numpy(), hot["owner"].to_numpy()))
    names = [f"w{k + 1}" for k in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, owner = shared.value
        for batch in batches:
            for blob, number in zip(*batch.columns, strict=True):
                raw = np.frombuffer(blob.as_buffer(), np.int32)
                ids, at = raw & NUMBER, starts(raw < 0, width)
                if not len(hot) or not len(at):
                    continue
                buckets = _bucket(ids, at, width)
                near = np.minimum(np.searchsorted(hot, buckets), len(hot) - 1)
                named = (hot[near] == buckets) & ((owner[near] == number.as_py() >> 32) | (owner[near] == -1))
                rows = np.unique(np.stack([ids[at[named] + k] for k in range(width)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(rows[:, k]) for k in range(width)], names=names)

    rows = texts.where("ids IS NOT NULL").select("ids", "number")
    return rows.mapInArrow(run, ", ".join(f"{c} int" for c in names)).distinct()


def _counted(
    texts: DataFrame, trie: DoubleArray, size: int, width: int, last: bool
) -> tuple[DataFrame, np.ndarray]:
    """The texts with windows that are keys of the trie marked, and how often each key occurs.

    The ``last`` trie of a level leaves the texts as the next level reads them.
    """
    shared = texts.sparkSession.sparkContext.broadcast(trie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, counts, numbers = shared.value, np.zeros(size, np.int64), _Numbers()
        for batch in batches:
            for blob in batch.column(0):
                raw = np.frombuffer(blob.as_buffer(), np.int32)
                ids = raw & NUMBER
                at, value = walk_phrases(trie, ids, starts(raw < 0, width), width)
                counts += np.bincount(value - 1, minlength=size)
                found = (raw & FOUND) != 0
                found[at] = True
                if last:
                    left = passed_on(ids, found, width) if width < LONGEST else None
                else:
                    left = np.where(found, raw | FOUND, raw).tobytes()
                if left is not None:
                    yield numbers.text(left)
        yield from _count_rows(counts)

    texts = stored(texts.where("ids IS NOT NULL").select("ids").mapInArrow(run, PARTS), f"level-{width}")
    total = _summed(texts.where("block IS NOT NULL"), size)
    shared.unpersist()
    return texts, total


def _in_turn(rows: DataFrame, keys: list[str], most_keys: int) -> tuple[int, Callable[[int], pa.Table]]:
    """Into how many tries the rows go, and the rows of one, sorted."""
    n = max(1, math.ceil(rows.count() / most_keys))
    shard = F.pmod(F.xxhash64(*keys), F.lit(n))
    return n, lambda turn: rows.where(shard == turn).orderBy(*keys).toArrow()


def phrase_counts(
    docs: DataFrame,
    support: int = SUPPORT,
    lang_col: str = "lang",
    text_col: str = "text",
    most_keys: int = MOST_KEYS,
    most_hot: int = MOST_HOT,
) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of one to ``LONGEST`` words (lang, phrase, k, f), and lang, n of all words."""
    spark = docs.sparkSession
    counts = word_counts(docs, lang_col, text_col)
    counts = stored(counts.where((F.col("f") >= support) | (F.col("word") == "")), "words")
    sizes = counts.where("word = ''").select("lang", F.col("f").alias("n"))

    frequent = counts.where((F.col("word") != "") & (F.col("f") >= support))
    n_tries, rows_of = _in_turn(frequent, ["lang", "word"], most_keys)
    vocabulary, offset = [], 0

    def word_tries() -> Iterator[tuple[DoubleArray, int]]:
        nonlocal offset
        for turn in range(n_tries):
            rows = rows_of(turn)
            keys = [
                lang.encode() + b"\n" + word.encode()
                for lang, word in zip(rows["lang"].to_pylist(), rows["word"].to_pylist(), strict=True)
            ]
            ids = np.arange(len(keys), dtype=np.int32) + offset + 1
            vocabulary.append(stored(spark.createDataFrame(rows.append_column("id", pa.array(ids))), "vocabulary"))
            yield double_array(keys), offset
            offset += len(keys)

    texts = _numbered_texts(spark, _texts(docs, lang_col, text_col), word_tries(), n_tries)
    words = _union(vocabulary)
    named = words.select(F.col("id").alias("w1"), "lang", F.col("word").alias("phrase"), "f")
    levels = [named]
    for width in range(2, LONGEST + 1):
        columns = [f"w{k + 1}" for k in range(width)]
        hot = stored(_hot_buckets(texts, width, support), "buckets")
        n_lots, lot_of = _in_turn(hot, ["bucket"], most_hot)
        found = _union([_candidates(texts, lot_of(i), width) for i in range(n_lots)])
        before = levels[-1].select(*columns[:-1])
        after = before.toDF(*columns[1:])
        # Both parts are frequent; bounded by nothing but their number, so Spark picks the joins.
        found = found.join(before, columns[:-1], "left_semi").join(after, columns[1:], "left_semi")
        found = stored(found.select(*columns), "candidates")
        n_tries, rows_of = _in_turn(found, columns, most_keys)
        kept = []
        for turn in range(n_tries):
            rows = rows_of(turn)
            trie = double_array([phrase_key(r) for r in zip(*(c.to_pylist() for c in rows.columns), strict=True)])
            last = turn == n_tries - 1
            texts, total = _counted(texts, trie, rows.num_rows, width, last)
            rows = rows.append_column("f", pa.array(total)).filter(pa.array(total >= support))
            kept.append(stored(spark.createDataFrame(rows), "frequent"))
        levels.append(stored(_named(_union(kept), columns, levels[-1], words), "phrases"))
    phrases = [
        level.select("lang", "phrase", F.lit(k + 1).alias("k"), "f") for k, level in enumerate(levels)
    ]
    return _union(phrases), sizes


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _named(frequent: DataFrame, columns: list[str], before: DataFrame, words: DataFrame) -> DataFrame:
    """Frequent windows with their language and phrase."""
    first = before.select(*columns[:-1], "lang", F.col("phrase").alias("first"))
    word = words.select(F.col("id").alias(columns[-1]), "word")
    return (
        frequent.join(first, columns[:-1])
        .join(word, columns[-1])
        .select(*columns, "lang", F.concat_ws(" ", "first", "word").alias("phrase"), "f")
    )


def collocations(
    docs: DataFrame,
    support: int = SUPPORT,
    top: int = TOP,
    lang_col: str = "lang",
    text_col: str = "text",
    most_keys: int = MOST_KEYS,
    most_hot: int = MOST_HOT,
) -> DataFrame:
    """Each language's ``top`` phrases of two or more words: lang, rank, phrase, a, l, r, n, score, k.

    A phrase is scored by its weakest cut in two; one contained in a longer phrase just as frequent is dropped.
    """
    phrases, sizes = phrase_counts(docs, support, lang_col, text_col, most_keys, most_hot)
    several = phrases.where("k > 1")
    # A longer phrase as frequent makes the one a word longer as frequent too.
    inside = several.where("k > 2").select(
        "lang", "f", F.split("phrase", " ").alias("ws"), (F.col("k") - 1).alias("m")
    )
    held = (
        inside.select("lang", "f", F.expr("slice(ws, 1, m)").alias("ws"))
        .unionByName(inside.select("lang", "f", F.expr("slice(ws, 2, m)").alias("ws")))
        .groupBy("lang", F.array_join("ws", " ").alias("phrase"))
        .agg(F.max("f").alias("longer"))
    )
    alone = several.join(held, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 100 * f")
    cuts = alone.select(
        "lang", "phrase", "k", F.col("f").alias("a"), F.explode(F.expr("sequence(1, k - 1)")).alias("cut")
    )
    words = F.split("phrase", " ")
    cuts = cuts.withColumn("first", F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ")).withColumn(
        "rest", F.array_join(F.slice(words, F.col("cut") + 1, F.col("k")), " ")
    )
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))

    def exact(name: str) -> str:
        return f"CAST({name} AS DECIMAL(19, 0))"

    score = f"CAST((CAST(1000 AS DECIMAL(4, 0)) * {exact('a')} * {exact('n')}) DIV ({exact('l')} * {exact('r')}) AS BIGINT)"
    scored = (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .join(sizes, "lang")
        .withColumn("score", F.expr(score))
        .groupBy("lang", "phrase", "k", "a", "n")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("weakest"))
        .select("lang", "phrase", "a", "weakest.l", "weakest.r", "n", "weakest.score", "k")
    )
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "k"
    )
