"""Exact top-k by inner product: ball trees per shard, searched by branch and bound.

Candidates are dealt to shards by a hash of their id, queries to blocks, and each pair of
shard and block is one task group of bounded size. A shard's distinct vectors form a
ball tree; ``q.c + |q| r`` bounds the inner products of q with a ball of centre c
and radius r. A block descends the tree together, each query to the child of the larger
bound first, and leaves a ball whose bound is below its k-th score so far.

The k-th score is shared: a first pass over one shard gives every query a score that its
final k-th cannot fall below, and all shards start from it.

Vectors are scaled to integers, so scores are exact. Rows without an id, without a
vector or with a component that is null or not finite take no part; vectors of different length
do not meet. Equal vectors of a shard are one point with its smallest ids, so a
vector that many rows share costs no more than one. Rows repeating id and vector count once. An
empty table gives an empty result and other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARD_ROWS = 8192
BLOCK_ROWS = 4096
LEAF = 64
EXACT = float(1 << 53)


def integer_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024
) -> DataFrame:
    """id, v: components as floor(scale * x); unusable rows are gone."""
    whole = F.col(vector_col).isNotNull() & ~F.exists(
        vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return vectors.where(F.col(id_col).isNotNull() & whole).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(
            vector_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")
        ).alias("v"),
    )


class BallTree:
    """Balls over the rows of ``points``, halved between two far points."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.nodes: list[tuple[np.ndarray, float, int, int, np.ndarray | None]] = []
        if len(points):
            self._grow(np.arange(len(points)))

    def _grow(self, rows: np.ndarray) -> int:
        own = self.points[rows]
        centre = own.mean(0)
        apart = ((own - centre) ** 2).sum(1)
        radius = math.sqrt(apart.max(initial=0.0))
        number = len(self.nodes)
        self.nodes.append((centre, radius, -1, -1, rows))
        if len(rows) > LEAF:
            far = own[apart.argmax()]
            other = own[((own - far) ** 2).sum(1).argmax()]
            side = own @ (other - far)
            order = np.argsort(side, kind="stable")
            half = len(rows) // 2
            left, right = self._grow(rows[order[:half]]), self._grow(rows[order[half:]])
            self.nodes[number] = (centre, radius, left, right, None)
        return number


class Search:
    """The k best rows of one shard for a block of queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.k = k
        distinct, inverse = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, inverse.ravel()))
        starts = np.searchsorted(inverse.ravel()[order], np.arange(len(distinct) + 1))
        # One id more than asked for, as a query does not meet itself.
        self.ids = [
            np.unique(ids[order[a:b]])[: k + 1] for a, b in zip(starts, starts[1:], strict=False)
        ]
        self.exact = distinct
        self.tree = BallTree(distinct.astype(np.float64))

    def run(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray) -> list[list[tuple]]:
        self.q_ids, self.q = ids, queries.astype(np.float64)
        self.q_exact = queries
        self.norm = np.sqrt((self.q**2).sum(1))
        self.floor = floor.astype(np.float64)
        self.found: list[list[tuple]] = [[] for _ in ids]
        most = float(np.abs(queries).max(initial=0)) * float(np.abs(self.exact).max(initial=0))
        self.doubles = most * max(1, queries.shape[1]) < EXACT
        if self.tree.nodes and len(ids):
            self._visit(0, np.arange(len(ids)))
        return self.found

    def _bound(self, node: int, of: np.ndarray) -> np.ndarray:
        centre, radius = self.tree.nodes[node][:2]
        bound = self.q[of] @ centre + self.norm[of] * radius
        return bound + 1e-9 * (np.abs(bound) + self.norm[of] * (radius + 1)) + 1e-6

    def _visit(self, node: int, of: np.ndarray) -> None:
        of = of[self._bound(node, of) >= self.floor[of]]
        if not len(of):
            return
        _, _, left, right, rows = self.tree.nodes[node]
        if rows is not None:
            self._leaf(rows, of)
            return
        first = self._bound(left, of) >= self._bound(right, of)
        for child, part in ((left, of[first]), (right, of[first]), (right, of[~first]), (left, of[~first])):
            if len(part):
                self._visit(child, part)

    def _leaf(self, rows: np.ndarray, of: np.ndarray) -> None:
        if self.doubles:
            scores = self.q[of] @ self.tree.points[rows].T
        else:
            scores = self.q_exact[of] @ self.exact[rows].T
        for q, line in zip(of, scores, strict=True):
            hits = np.flatnonzero(line >= self.floor[q])
            if not len(hits):
                continue
            best, own = self.found[q], self.q_ids[q]
            for h in hits:
                score = int(line[h])
                best.extend((-score, int(i)) for i in self.ids[rows[h]] if i != own)
            best.sort()
            del best[self.k :]
            if len(best) == self.k:
                self.floor[q] = max(self.floor[q], -best[-1][0])


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    flat = table.column(column).combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(table.num_rows, -1) if table.num_rows else values.reshape(0, 0)


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 10,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score; both inputs as ``integer_vectors`` gives them."""
    n_shards = max(1, math.ceil(candidates.count() / shard_rows))
    n_blocks = max(1, math.ceil(queries.count() / block_rows))
    shard = F.pmod(F.xxhash64("id"), F.lit(n_shards)).cast("int")
    block = F.pmod(F.xxhash64(F.lit(1), F.col("id")), F.lit(n_blocks)).cast("int")
    parts = candidates.select("id", "v", F.size("v").alias("dim"), shard.alias("shard"))
    asked = queries.select(
        F.col("id").alias("query_id"), F.col("v").alias("q"), F.size("v").alias("dim"), block.alias("block")
    )
    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard")

    def search(own: pa.Table, others: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if own.num_rows and others.num_rows:
            ids = own.column("query_id").to_numpy()
            hits = Search(others.column("id").to_numpy(), _matrix(others, "v"), k).run(
                ids, _matrix(own, "q"), own.column("floor").to_numpy()
            )
            out = [(int(q), i, -s) for q, best in zip(ids, hits, strict=True) for s, i in best]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table(
            {n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)}
        )

    def searched(asked: DataFrame, parts: DataFrame) -> DataFrame:
        keys = ["dim", "shard", "block"]
        return (
            asked.groupBy(*keys)
            .cogroup(parts.select("*", every_block).groupBy(*keys))
            .applyInArrow(search, "query_id long, vec_id long, score long")
        )

    lowest = F.lit(-(1 << 62)).cast("long")
    pilot = searched(
        asked.select("*", F.lit(0).alias("shard"), lowest.alias("floor")), parts.where("shard = 0")
    )
    # A repeated query row finds the same candidates again.
    known = pilot.distinct().groupBy("query_id").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    shared = (
        asked.join(known.where(F.col("n") >= k), "query_id", "left")
        .select("query_id", "q", "dim", "block", F.coalesce("kth", lowest).alias("floor"))
        .select("*", every_shard)
    )
    found = searched(shared, parts)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
