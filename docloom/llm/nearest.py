"""Approximate nearest neighbours by largest inner product, with projections and kd-trees.

Vectors are brought to unit length by one more component, so that the largest inner
product is the smallest distance. 2-stable (normal) random projections take them to
``DIMENSIONS`` dimensions, where the squared distance, relative to the true one, follows
a chi-square law. All rows are indexed: shards of about ``SHARD_ROWS`` rows each build a
kd-tree over their projections.

A query takes the leaves of a tree by their projected distance and verifies the rows in
them on the original vectors. It stops when the next leaf is so far that a row within
the distance of the current k-th neighbour would lie nearer with probability
``CONFIDENCE``. Blocks of queries meet shards of rows, both of bounded size, and each
pair gives k rows per query at most, from which the k best are taken.

Definitions. Vectors that are null, empty, zero, or hold null or non-finite components
take no part, and neither do rows without an id. Rows that repeat an id count once, with
the smallest of their vectors. Vectors of another length than the query's aren't
candidates. Equal scores rank by the smaller id. Other columns play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import stage

#: Neighbours of a query.
K = 20
#: Ids divisible by this are queries.
EVERY = 20
#: Dimensions of the projections; even, as the chi-square law then has a closed form.
DIMENSIONS = 8
#: Probability at which a query stops.
CONFIDENCE = 0.98
#: Rows in a shard and in a leaf, queries in a block.
SHARD_ROWS = 20_000
LEAF_ROWS = 128
BLOCK_QUERIES = 4_000
SEED = 41


def chi_square_quantile(p: float, freedom: int) -> float:
    """Inverse of the chi-square law with an even number of degrees of freedom."""

    def below(x: float) -> float:
        terms = sum((x / 2) ** i / math.factorial(i) for i in range(freedom // 2))
        return 1 - math.exp(-x / 2) * terms

    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


class Tree:
    """A kd-tree's leaves: rows of each leaf and the bounds of their projections."""

    def __init__(self, points: np.ndarray) -> None:
        self.leaves: list[np.ndarray] = []
        todo = [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF_ROWS:
                self.leaves.append(rows)
                continue
            spread = points[rows]
            axis = int(np.argmax(spread.max(axis=0) - spread.min(axis=0)))
            half = len(rows) // 2
            order = np.argpartition(spread[:, axis], half)
            todo += [rows[order[:half]], rows[order[half:]]]
        self.low = np.array([points[r].min(axis=0) for r in self.leaves])
        self.high = np.array([points[r].max(axis=0) for r in self.leaves])

    def distances(self, queries: np.ndarray) -> np.ndarray:
        """Squared distances from queries to the leaves' boxes."""
        out = np.zeros((len(queries), len(self.leaves)))
        for axis in range(queries.shape[1]):
            q = queries[:, axis, None]
            gap = np.maximum(0, np.maximum(self.low[:, axis] - q, q - self.high[:, axis]))
            out += gap * gap
        return out


def search(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, longest: float
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the neighbours found, best first; the score is -inf where there are none.

    ``longest`` is the largest norm of all rows of the collection.
    """
    width = rows.shape[1]
    normal = np.random.default_rng(SEED + width).standard_normal((width + 1, DIMENSIONS))
    scaled = rows / longest
    lifted = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
    tree = Tree(scaled @ normal[:-1] + lifted[:, None] * normal[-1])
    norms = np.sqrt((queries * queries).sum(axis=1))
    away = tree.distances((queries / norms[:, None]) @ normal[:-1])
    order = np.argsort(away, axis=1, kind="stable")
    best = np.full((len(queries), K), -np.inf)
    found = np.full((len(queries), K), -1, np.int64)
    factor = chi_square_quantile(CONFIDENCE, DIMENSIONS)
    active = np.arange(len(queries))
    for turn in range(len(tree.leaves)):
        leaf = order[active, turn]
        # squared distance of the k-th neighbour after the lift to unit length
        kth = 2.0 - 2.0 * best[active, K - 1] / (norms[active] * longest)
        go = away[active, leaf] <= factor * kth
        active, leaf = active[go], leaf[go]
        if not len(active):
            break
        by_leaf = np.argsort(leaf, kind="stable")
        cuts = np.flatnonzero(np.diff(leaf[by_leaf])) + 1
        for group in np.split(by_leaf, cuts):
            asked, members = active[group], tree.leaves[leaf[group[0]]]
            scores = queries[asked] @ rows[members].T
            names = np.broadcast_to(ids[members], scores.shape)
            scores = np.where(names == query_ids[asked, None], -np.inf, scores)
            scores = np.concatenate([best[asked], scores], axis=1)
            names = np.concatenate([found[asked], names], axis=1)
            top = np.lexsort((names, -scores), axis=1)[:, :K]
            best[asked] = np.take_along_axis(scores, top, axis=1)
            found[asked] = np.take_along_axis(names, top, axis=1)
    return found, best


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, width) of the rows that take part, one per id."""
    given = vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    part = given.where(
        F.col("vec_id").isNotNull()
        & F.coalesce(finite, F.lit(False))
        & F.exists("embedding", lambda x: x != 0)
    )
    return (
        part.groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
        .withColumn("width", F.size("embedding"))
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _meet(rows: pa.Table, queries: pa.Table) -> pa.Table:
    none = {"query_id": [], "vec_id": [], "score": []}
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not rows.num_rows or not queries.num_rows:
        return pa.table(none, schema)
    ids, query_ids = rows.column("vec_id").to_numpy(), queries.column("query_id").to_numpy()
    longest = float(queries.column("longest")[0].as_py())
    vectors, asked = _matrix(rows.column("embedding")), _matrix(queries.column("query"))
    found, scores = search(ids, vectors, query_ids, asked, longest)
    there = scores > -np.inf
    asked = np.broadcast_to(query_ids[:, None], found.shape)
    return pa.table(
        {"query_id": asked[there], "vec_id": found[there], "score": scores[there]}, schema
    )


def neighbours(vectors: DataFrame) -> DataFrame:
    """(query_id, rank, vec_id, score) of the queries among ``vectors``."""
    part = stage(usable(vectors), "nearest_vectors")
    is_query = F.col("vec_id") % EVERY == 0
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    # per width: how many shards and blocks, and the largest norm
    plan = stage(
        part.groupBy("width").agg(
            F.greatest(F.ceil(F.count(F.lit(1)) / SHARD_ROWS), F.lit(1)).alias("shards"),
            F.greatest(F.ceil(F.count_if(is_query) / BLOCK_QUERIES), F.lit(1)).alias("blocks"),
            (F.sqrt(F.max(square)) * (1 + 1e-12)).alias("longest"),
        ),
        "nearest_plan",
    )
    known = part.join(plan, "width")
    spread = F.xxhash64("vec_id")
    rows = known.select(
        "vec_id",
        "embedding",
        "width",
        F.pmod(spread, F.col("shards")).alias("shard"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
    )
    queries = known.where(is_query).select(
        F.col("vec_id").alias("query_id"),
        F.col("embedding").alias("query"),
        F.col("width").alias("of_width"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("of_shard"),
        F.pmod(spread, F.col("blocks")).alias("of_block"),
        F.col("longest").alias("longest"),
    )
    met = (
        rows.groupBy("width", "shard", "block")
        .cogroup(queries.groupBy("of_width", "of_shard", "of_block"))
        .applyInArrow(_meet, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= K)
        .select("query_id", "rank", "vec_id", "score")
    )
