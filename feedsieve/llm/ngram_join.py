"""Near duplicates by a Jaccard join on word shingles, exact.

Texts with the same set are one class, carried by its smallest id; classes are numbered in the order of
these ids, classes without any id last, and below, the ids of pairs are these numbers. Two classes can only be
similar if they share one of the first ``n - ceil(t n) + 1`` shingles of a common
order, so these are the keys on which candidates meet. The order puts shingles that a
bounded sample finds frequent last and else goes by hash: it decides how many
candidates meet, never which links are found.

Each class has a count vector: its shingles hashed into groups and counted. The number of groups, a
power of two, grows with the set, or the counts of long texts would all look alike; adding its
halves folds a vector to fewer groups. The overlap of two sets is at most the sum of the smaller
counts, group by group. Within a key the vectors form R-trees, one for each number of groups, whose
boxes bound that sum for all pairs below two nodes, and pairs whose bound reaches the overlap they
need are verified on whole texts.

Only connectedness is asked for, so each key first links its members to its smallest
one, and afterwards only pairs that are not yet connected are looked for. A dense
group of near copies so costs about as many comparisons as it has members. Keys
with many members are dealt to blocks and joined block by block.

Sets are compared through 64-bit hashes of their shingles. Null text is the empty text;
a text without words links with nothing. Rows without an id take part only if asked for: each
is returned, with no component if none of its component has an id. Repeated rows count once, and an id
with several sets has a row for each. An empty table gives an empty result and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.llm.common import slices, stored, whole_text
from feedsieve.llm.components import smallest_reachable
from feedsieve.llm.shingles import shingle_sets

WIDTH = 5
PERCENT = 80
LEAST_GROUPS, MOST_GROUPS = 64, 4096
SAMPLE_DOCS = 4_000
FREQUENT = 50_000
FREQUENT_IN = 3  # of the sampled documents
BLOCK = 2_048
NODE = 16
SLICE_BYTES = 1 << 19
BROADCAST_IDS = 1_000_000  # of eight bytes each; more are joined by a shuffle
VECTOR = T.BinaryType()


def needed_overlap(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap at which sets of n and m reach the threshold."""
    return -(-(percent * (n + m)) // (100 + percent))


def count_vector(hashes: np.ndarray) -> np.ndarray:
    """Shingles by group, one or two in each; a count of 255 stands for any larger one."""
    groups = min(MOST_GROUPS, max(LEAST_GROUPS, 1 << (max(1, len(hashes)) // 2).bit_length()))
    counts = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % groups, minlength=groups)
    return np.minimum(counts, 255).astype(np.uint8)


def folded(vectors: np.ndarray, groups: int) -> np.ndarray:
    """Rows of counts in fewer groups; a full count stays full."""
    while vectors.shape[1] > groups:
        half = vectors.shape[1] // 2
        both = vectors[:, :half].astype(np.int64) + vectors[:, half:]
        vectors = np.minimum(both, 255).astype(np.uint8)
    return vectors


def stacked(vectors: list[bytes]) -> np.ndarray:
    """A matrix of vectors of one length."""
    return np.frombuffer(b"".join(vectors), np.uint8).reshape(len(vectors), -1)


def overlap_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of smaller counts along the last axis; full counts may hide any overlap."""
    least = np.minimum(a, b)
    bound = least.sum(-1, dtype=np.int64)
    return np.where((least == 255).any(-1), np.iinfo(np.int64).max, bound)


class RTree:
    """Boxes over sizes and count vectors, halved along the widest group."""

    def __init__(self, sizes: np.ndarray, vectors: np.ndarray):
        self.sizes, self.vectors = sizes, vectors
        self.nodes: list[tuple[int, int, np.ndarray, int, int, np.ndarray | None]] = []
        self.root = self._grow(np.arange(len(sizes)))

    def _grow(self, rows: np.ndarray) -> int:
        number = len(self.nodes)
        low, high = int(self.sizes[rows].min()), int(self.sizes[rows].max())
        top = self.vectors[rows].max(0)
        self.nodes.append((low, high, top, -1, -1, rows))
        if len(rows) > NODE:
            if high > low * 1.25:
                along = self.sizes[rows]
            else:
                own = self.vectors[rows]
                along = own[:, own.astype(np.float32).var(0).argmax()]
            order = rows[np.argsort(along, kind="stable")]
            half = len(order) // 2
            left, right = self._grow(order[:half]), self._grow(order[half:])
            self.nodes[number] = (low, high, top, left, right, None)
        return number


def candidate_pairs(
    one: RTree, other: RTree, percent: int, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs whose bound reaches the overlap they need."""
    waiting = [(one.root, other.root)]
    while waiting:
        a, b = waiting.pop()
        low_a, high_a, top_a, left_a, right_a, rows_a = one.nodes[a]
        low_b, high_b, top_b, left_b, right_b, rows_b = other.nodes[b]
        if 100 * high_a < percent * low_b or 100 * high_b < percent * low_a:
            continue
        if overlap_bound(top_a, top_b) < needed_overlap(low_a, low_b, percent):
            continue
        if rows_a is not None and rows_b is not None:
            n, m = one.sizes[rows_a][:, None], other.sizes[rows_b][None]
            bound = overlap_bound(one.vectors[rows_a][:, None], other.vectors[rows_b][None])
            near = (100 * n >= percent * m) & (100 * m >= percent * n)
            i, j = np.nonzero(near & (bound >= needed_overlap(n, m, percent)))
            i, j = rows_a[i], rows_b[j]
            if same and a == b:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j
        elif same and a == b:
            waiting += [(left_a, left_a), (left_a, right_a), (right_a, right_a)]
        elif rows_b is not None or (rows_a is None and high_a - low_a >= high_b - low_b):
            waiting += [(left_a, b), (right_a, b)]
        else:
            waiting += [(a, left_b), (a, right_b)]


def _sha(text_col: str) -> Column:
    return F.unhex(F.sha2(whole_text(text_col), 256))


def _texts(docs: DataFrame, id_col: str, text_col: str, nameless: bool) -> DataFrame:
    """id, text and sha, which together tell rows without an id or with a repeated one."""
    return docs.where(F.lit(nameless) | F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"), _sha(text_col).alias("sha")
    )


def _sets(batch: pa.RecordBatch, at: int, width: int) -> list[np.ndarray]:
    return shingle_sets([t.encode() for t in batch.column(at).to_pylist()], width)


def _own_text() -> Column:
    """Whether a text is that of the row ``own``, ``own_sha``."""
    return F.col("id").eqNullSafe(F.col("own")) & (F.col("sha") == F.col("own_sha"))


def frequent_shingles(texts: DataFrame, width: int = WIDTH, sample: int = SAMPLE_DOCS) -> np.ndarray:
    """Sorted hashes of the shingles that recur in a sample of documents."""
    order = F.when(F.col("id").isNull(), F.xxhash64("sha")).otherwise(F.xxhash64("id"))
    chosen = texts.select("id", "sha").orderBy(order).limit(sample).distinct()
    chosen = chosen.select(F.col("id").alias("own"), F.col("sha").alias("own_sha"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                hashes = np.concatenate([*_sets(part, 1, width), np.zeros(0, np.uint64)])
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], names=["h"])

    counted = (
        texts.join(F.broadcast(chosen), _own_text(), "left_semi")  # ``sample`` ids
        .select("id", "text")
        .mapInArrow(run, "h long")
        .groupBy("h")
        .count()
        .where(F.col("count") >= FREQUENT_IN)
        .orderBy(F.desc("count"), "h")
        .limit(FREQUENT)
    )
    return np.sort(np.array([r["h"] for r in counted.collect()], np.int64).view(np.uint64))


def shapes(texts: DataFrame, width: int, percent: int, frequent: np.ndarray | None) -> DataFrame:
    """id, sha, digest of the set, n, vec and, given the order, the keys and whether each is frequent."""
    with_keys = frequent is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                sets = _sets(part, 1, width)
                columns = [
                    part.column(0),
                    part.column(2),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([count_vector(s).tobytes() for s in sets], pa.binary()),
                ]
                if with_keys:
                    keys = []
                    for s in sets:
                        n = len(s)
                        length = n - -(-percent * n // 100) + 1 if n else 0
                        common = np.zeros(n, bool)
                        if len(frequent):
                            near = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                            common = frequent[near] == s
                        first = np.concatenate((s[~common], s[common]))[:length]
                        keys.append(first.view(np.int64))
                    columns.append(pa.array(keys, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    fields = [
        T.StructField("id", T.LongType()),
        T.StructField("sha", T.BinaryType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("n", T.LongType()),
        T.StructField("vec", VECTOR),
    ]
    if with_keys:
        fields.append(T.StructField("keys", T.ArrayType(T.LongType())))
    schema = T.StructType(fields)
    return texts.mapInArrow(run, schema)


def numbered_classes(shaped: DataFrame) -> DataFrame:
    """digest, id (its number), n, vec of each class, and the id and text of its first row."""
    own = F.struct(F.col("id").isNull().alias("nameless"), F.col("id").alias("own"), F.col("sha").alias("own_sha"))
    return (
        shaped.where("n > 0")
        .groupBy("digest")
        .agg(F.min(own).alias("first"), F.first("n").alias("n"), F.first("vec").alias("vec"))
        .select("digest", "n", "vec", "first.*")
        # The numbers grow with the sorted partitions; they hold once the table is stored.
        .orderBy("nameless", "own", "digest")
        .withColumn("id", F.monotonically_increasing_id())
        .drop("nameless")
    )


def postings(texts: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """key, id, head: members of the keys that several classes share, with the smallest."""
    frequent = frequent_shingles(texts, width)
    keyed = shapes(texts, width, percent, frequent)
    own = keyed.groupBy("digest").agg(F.first("keys").alias("keys"))
    rows = own.join(classes.select("digest", "id"), "digest").select("id", F.explode("keys").alias("key"))
    # At most ``FREQUENT`` keys.
    hot = F.broadcast(
        rows.sparkSession.createDataFrame([(int(h),) for h in frequent.view(np.int64)], "key long")
    )
    # A key that the sample doesn't find frequent has few of all documents.
    same = W.partitionBy("key")
    cold = (
        rows.join(hot, "key", "left_anti")
        .withColumn("head", F.min("id").over(same))
        .withColumn("m", F.count(F.lit(1)).over(same))
        .where("m > 1")
    )
    # The others meet by a map-side aggregate and a join that can be split.
    often = rows.join(hot, "key", "left_semi")
    heads = often.groupBy("key").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("m"))
    warm = often.join(heads.where("m > 1"), "key")
    return cold.select("key", "id", "head", "m").unionByName(warm.select("key", "id", "head", "m"))


def bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and count vectors allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m, u, v = (batch.column(i) for i in range(6))
            n, m = n.to_numpy(), m.to_numpy()
            wide = np.stack([pc.binary_length(x).to_numpy() for x in (u, v)])
            u, v = u.to_pylist(), v.to_pylist()
            stays = (100 * n >= percent * m) & (100 * m >= percent * n)
            for widths in np.unique(wide[:, stays], axis=1).T:
                at = np.flatnonzero(stays & (wide == widths[:, None]).all(0))
                x, y = (folded(stacked([side[k] for k in at]), widths.min()) for side in (u, v))
                stays[at] = overlap_bound(x, y) >= needed_overlap(n[at], m[at], percent)
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(stays))

    left = classes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("vec").alias("vec_a"))
    right = classes.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("vec").alias("vec_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", "n_a", "n_b", "vec_a", "vec_b")
        .mapInArrow(run, "a long, b long")
    )


def _texts_of(pairs: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    asked = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    first = classes.join(asked, "id", "left_semi").select(F.col("id").alias("number"), "own", "own_sha")
    first = stored(first, "asked")
    if first.count() <= BROADCAST_IDS:
        first = F.broadcast(first)
    return (
        texts.join(first, _own_text())
        .select(F.col("number").alias("id"), "text")
        .dropDuplicates(["id"])
    )


def verified(pairs: DataFrame, texts: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b), of a stored table, whose whole texts reach the threshold."""
    wanted = _texts_of(pairs, texts, classes)
    left = wanted.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = wanted.select(F.col("id").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, 3, SLICE_BYTES):
                x, y = part.column(2).to_pylist(), part.column(3).to_pylist()
                new = list({t for t in x + y if t not in known})
                if len(known) > 2_000:
                    known.clear()
                    new = list({*x, *y})
                known.update(zip(new, shingle_sets([t.encode() for t in new], width), strict=True))
                stays = []
                for p, q in zip(x, y, strict=True):
                    p, q = known[p], known[q]
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    stays.append(both > 0 and 100 * both >= percent * (len(p) + len(q) - both))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1)], names=["a", "b"]
                ).filter(pa.array(stays, pa.bool_()))

    return (
        pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        .mapInArrow(run, "a long, b long")
    )


def unconnected_pairs(members: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of one key and different components that the R-tree lets through.

    ``members`` has key, m (its members), id, component, n and vec.
    """
    blocks = F.ceil(F.col("m") / block).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn(
        "own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    spread = dealt.select(
        "key", "id", "component", "n", "vec", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("met")
    ).select(
        "key", "id", "component", "n", "vec", "own",
        F.least("own", "met").alias("i"), F.greatest("own", "met").alias("j"),
    )

    def search(i: int, j: int, group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids, component, sizes, own = (
            group.column(c).to_numpy() for c in ("id", "component", "n", "own")
        )
        vectors = group.column("vec").to_pylist()
        wide = np.array([len(v) for v in vectors])
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        trees: dict[tuple[int, int, int], RTree] = {}

        def tree(side: int, width: int, groups: int) -> tuple[np.ndarray, RTree]:
            """Rows and tree of a block's vectors of one width, in fewer groups."""
            rows = np.flatnonzero((own == side) & (wide == width))
            if (side, width, groups) not in trees:
                counts = folded(stacked([vectors[r] for r in rows]), groups)
                trees[side, width, groups] = RTree(sizes[rows], counts)
            return rows, trees[side, width, groups]

        def extent(side: int) -> list[tuple[int, int, int]]:
            """Widths of a block with the least and greatest size."""
            of = {w: sizes[(own == side) & (wide == w)] for w in np.unique(wide[own == side]).tolist()}
            return [(w, int(n.min()), int(n.max())) for w, n in of.items()]

        for w, low, high in extent(i):
            for x, least, most in extent(j):
                if i == j and x < w or 100 * high < percent * least or 100 * most < percent * low:
                    continue
                (one, left), (other, right) = tree(i, w, min(w, x)), tree(j, x, min(w, x))
                for p, q in candidate_pairs(left, right, percent, i == j and w == x):
                    p, q = one[p], other[q]
                    apart = component[p] != component[q]
                    a.append(ids[p[apart]])
                    b.append(ids[q[apart]])
        a, b = np.concatenate(a), np.concatenate(b)
        return np.minimum(a, b), np.maximum(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by key and blocks; a group, of two blocks at most, may go on in the next batch."""
        rest: pa.Table | None = None

        def found(table: pa.Table) -> pa.RecordBatch:
            marks = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
            edges = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1
            cuts = [0, *edges.tolist(), table.num_rows]
            pairs = [
                search(int(marks[1, x]), int(marks[2, x]), table.slice(x, y - x))
                for x, y in zip(cuts, cuts[1:], strict=False)
                if y - x > 1
            ]
            none = [(np.zeros(0, np.int64),) * 2]
            both = np.unique(np.concatenate([np.stack(p) for p in pairs + none], 1), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table]).combine_chunks()
            marks = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
            done = int((marks != marks[:, -1:]).any(0).sum()) if table.num_rows else 0
            if done:
                yield found(table.slice(0, done))
            rest = table.slice(done)
        if rest is not None and rest.num_rows:
            yield found(rest)

    together = spread.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return together.mapInArrow(run, "a long, b long").distinct()


def _linked(
    docs: DataFrame, width: int, percent: int, id_col: str, text_col: str, nameless: bool
) -> DataFrame:
    """id, sha, digest, n of every row, and kept_id, kept_sha of the first row of its component."""
    texts = _texts(docs, id_col, text_col, nameless)
    shaped = stored(shapes(texts, width, percent, None), "shapes")
    classes = stored(numbered_classes(shaped), "classes")
    shared = stored(postings(texts, classes, width, percent), "postings")

    stars = shared.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    near = stored(bounded(stars, classes, percent), "stars")
    links = stored(verified(near, texts, classes, width, percent), "links")
    component = smallest_reachable(links)

    # The smallest of a key has met all others; among these, some may not be connected.
    known = (
        shared.where("m > 2 AND id <> head")
        .select("key", "id", "m")
        .join(component, "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    split = (
        known.groupBy("key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.struct(
                F.count(F.lit(1)),
                F.bit_xor(F.xxhash64(F.lit(1), F.col("id"))),
                F.bit_xor(F.xxhash64(F.lit(2), F.col("id"))),
            ).alias("members"),
        )
        .where("low <> high")
        # Of keys with the same members, one will do.
        .groupBy("members")
        .agg(F.min("key").alias("key"))
        .select("key")
    )
    members = known.join(split, "key", "left_semi").join(classes.select("id", "n", "vec"), "id")
    rest = stored(unconnected_pairs(members, percent), "rest")
    tried = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    untried = stored(rest.join(tried, ["a", "b"], "left_anti"), "untried")
    more = verified(untried, texts, classes, width, percent)
    component = smallest_reachable(links.unionByName(more).select("a", "b"))
    first = classes.select(
        F.col("id").alias("component"), F.col("own").alias("kept_id"), F.col("own_sha").alias("kept_sha")
    )
    ends = (
        classes.select("digest", "id")
        .join(component, "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
        .join(first, "component")
        .select("digest", "kept_id", "kept_sha")
    )
    return shaped.select("id", "sha", "digest", "n").join(ends, "digest", "left")


def near_components(
    docs: DataFrame,
    width: int = WIDTH,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    nameless: bool = False,
) -> DataFrame:
    """id, n_shingles, component_id: the smallest id reachable by links.

    With ``nameless``, rows without an id take part and are all returned.
    """
    found = _linked(docs, width, percent, id_col, text_col, nameless).select(
        "id", "digest", "n", F.coalesce("kept_id", "id").alias("component")
    )
    rows = found.where("id IS NOT NULL").distinct()
    if nameless:
        rows = rows.unionByName(found.where("id IS NULL"))
    return rows.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


def keep_smallest(
    docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component: that of the smallest id.

    Rows without an id lose against any row with one; if a component has no other rows, those
    with one of its texts stay. Rows are told by id and text together.
    """
    found = _linked(docs, WIDTH, percent, id_col, text_col, True)
    stays = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("kept_sha"))
    gone = found.where(F.col("kept_sha").isNotNull() & ~stays).select(
        F.col("id").alias("__gone_id"), F.col("sha").alias("__gone_sha")
    )
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__gone_id")) & (_sha(text_col) == F.col("__gone_sha"))
    return docs.join(gone.distinct(), same, "left_anti")
