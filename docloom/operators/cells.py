"""Exact search that leaves out the cells of a collection that can't hold a neighbour.

The vectors of a collection are dealt out to the nearest of some centroids, and stored by
cell with the distance of the farthest one. By the triangle inequality no vector of a cell is
nearer to a query than the query's distance to the centroid less that radius. A query first
searches its nearest cells, as many as hold k vectors; the distance of the k-th tells which
of the other cells could hold a nearer one, and only those are searched. The result is that
of ``search.nearest``; how much is left out depends on how well the vectors cluster.

The centroids are fitted to a sample of bounded size, in which any choice is right: every
vector is stored in a cell, and the radii are those of all vectors. Vectors of another width
than most have a cell of their width, which queries of that width search whole. The index is
that of a collection as it was; after inserts it is built again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docloom.operators import search
from docloom.shared import write_stage

# Cells of a new index; their centroids are held by every task.
CELLS = 256
# Vectors that the centroids are fitted to, on the driver.
SAMPLE = 1 << 14
# Rows of all cells for which one more task writes a cell.
TASK_ROWS = 1 << 20
# Rounds of fitting.
ROUNDS = 10


@dataclass
class Index:
    """``rows`` (chunk_id, embedding, cell) by cell, and what is known of the cells."""

    rows: DataFrame
    centroids: np.ndarray
    radii: np.ndarray
    counts: np.ndarray

    @property
    def width(self) -> int:
        return self.centroids.shape[1]


def _distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Distance of every vector to every centroid, summed from differences where it is small."""
    rough = (vectors**2).sum(1)[:, None] + (centroids**2).sum(1)[None, :] - 2.0 * vectors @ centroids.T
    return np.sqrt(np.maximum(rough, 0.0))


def _fitted(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centroids by Lloyd's rounds, from vectors spread over the sample."""
    centroids = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)]
    for _ in range(ROUNDS):
        nearest = _distances(sample, centroids).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        counts = np.bincount(nearest, minlength=len(centroids))
        full = counts > 0
        centroids = np.where(full[:, None], sums / np.maximum(counts, 1)[:, None], centroids)
    return np.unique(centroids, axis=0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = _matrix(batch.column("embedding"), centroids.shape[1])
        cell = _distances(vectors, centroids).argmin(1)
        reach = np.sqrt(((vectors - centroids[cell]) ** 2).sum(1))
        yield batch.append_column("cell", pa.array(cell, pa.int32())).append_column("reach", pa.array(reach))


def build(collection: DataFrame, name: str, cells: int = CELLS, sample: int = SAMPLE) -> Index:
    """Write the tables ``{name}__cells`` and ``{name}__centroids`` anew, and open them."""
    spark = collection.sparkSession
    rows = write_stage(search._searched(collection, False), "vectors")
    widths = rows.groupBy(F.size("embedding").alias("width")).count().withColumn("all", F.expr("sum(count) over ()"))
    most = widths.orderBy(F.desc("count"), F.desc("width")).first()
    width, total = (most.width, most.all) if most else (1, 0)
    main = rows.where(F.size("embedding") == width)
    drawn = main.orderBy(F.xxhash64("chunk_id"), "chunk_id").limit(sample).select("embedding").toArrow()
    vectors = _matrix(drawn.column("embedding").combine_chunks(), width)
    centroids = _fitted(vectors, cells) if len(vectors) else np.zeros((0, width))
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("reach", T.DoubleType())]
    )
    dealt = main.mapInArrow(partial(_assigned, centroids=centroids), schema)
    others = rows.where(F.size("embedding") != width).select("*", -F.size("embedding"), F.lit(0.0))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a cell may hold a third of all rows: more tasks write it, the more there are
    tasks = F.pmod(F.xxhash64("chunk_id"), F.lit(1 + total // TASK_ROWS))
    spread = dealt.union(others).repartition(partitions, "cell", tasks)
    (
        spread.sortWithinPartitions("cell", "reach")
        .write.format("parquet")
        .mode("overwrite")
        .partitionBy("cell")
        .saveAsTable(f"{name}__cells")
    )
    spark.catalog.refreshTable(f"{name}__cells")
    known = spark.table(f"{name}__cells").groupBy("cell").agg(F.max("reach").alias("radius"), F.count("*").alias("n"))
    found = {r.cell: (r.radius, r.n) for r in known.where("cell >= 0").collect()}  # one row a cell
    about = [(i, [float(x) for x in c], *found.get(i, (0.0, 0))) for i, c in enumerate(centroids)]
    table = spark.createDataFrame(about, "cell int, centroid array<double>, radius double, n long")
    table.write.format("parquet").mode("overwrite").saveAsTable(f"{name}__centroids")
    return open_index(spark, name)


def open_index(spark: SparkSession, name: str) -> Index:
    about = spark.table(f"{name}__centroids").orderBy("cell").collect()
    width = len(about[0].centroid) if about else 1
    return Index(
        spark.table(f"{name}__cells").select("chunk_id", "embedding", "cell"),
        np.array([r.centroid for r in about], np.float64).reshape(-1, width),
        np.array([r.radius for r in about], np.float64),
        np.array([r.n for r in about], np.int64),
    )


def _chosen(
    batches: Iterator[pa.RecordBatch],
    centroids: np.ndarray,
    radii: np.ndarray,
    counts: np.ndarray,
    k: int,
    first: bool,
    schema: pa.Schema,
) -> Iterator[pa.RecordBatch]:
    """Queries with the cells they search: the nearest ones that hold k vectors, or later those
    of the others that may hold one within the distance ``limit``."""
    for batch in batches:
        if not batch.num_rows or not len(centroids):
            continue
        vectors = _matrix(batch.column("embedding"), centroids.shape[1])
        distances = _distances(vectors, centroids)
        order = np.argsort(distances, axis=1, kind="stable")
        held = np.cumsum(counts[order], axis=1)
        nearest = np.zeros(distances.shape, bool)
        np.put_along_axis(nearest, order, held - counts[order] < k, axis=1)
        nearest &= counts > 0
        if first:
            wanted = nearest
        else:
            # the limit and the distances are rounded
            limit = np.sqrt(batch.column("limit").to_numpy(zero_copy_only=False))[:, None]
            scale = np.sqrt((vectors**2).sum(1))[:, None] + np.sqrt((centroids**2).sum(1))[None, :] + radii
            slack = 1e-7 * (1.0 + scale)
            wanted = ~nearest & (counts > 0) & (distances - radii <= limit + slack)
        which, cell = np.nonzero(wanted)
        taken = batch.select(["query", "embedding"]).take(pa.array(which))
        yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cell, pa.int32())], names=schema.names)


def _pairs(asked: DataFrame, index: Index, k: int, first: bool) -> DataFrame:
    """(query_id, embedding, cell): which query searches which cell."""
    schema = T.StructType(
        [
            T.StructField("query_id", T.LongType()),
            asked.schema["embedding"],
            T.StructField("cell", T.IntegerType()),
        ]
    )
    run = partial(
        _chosen,
        centroids=index.centroids,
        radii=index.radii,
        counts=index.counts,
        k=k,
        first=first,
        schema=to_arrow_schema(schema),
    )
    mine = F.size("embedding") == index.width
    found = asked.where(mine).mapInArrow(run, schema)
    if first:
        found = found.union(asked.where(~mine).select("query", "embedding", -F.size("embedding")))
    return write_stage(found, "cell-queries")


def _searched_cells(pairs: DataFrame, index: Index, k: int, block_bytes: int) -> DataFrame:
    needed = [r.cell for r in pairs.select("cell").distinct().collect()]  # at most all cells
    rows = index.rows.where(F.col("cell").isin(needed))
    partitions = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # queries of one cell come together; a cell that all of them search is several tasks' work
    dealt = pairs.repartition(partitions, "cell", F.pmod("query_id", F.lit(8)))
    return search._met(dealt, rows, k, search._groups(pairs, k, block_bytes))


def nearest(
    queries: DataFrame,
    index: Index,
    k: int = search.DEFAULT_K,
    block_bytes: int = search.BLOCK_BYTES,
) -> DataFrame:
    """(query_id, embedding) -> (query_id, rank, chunk_id, distance), as ``search.nearest``."""
    hits, _ = nearest_with_cells(queries, index, k, block_bytes)
    return hits


def nearest_with_cells(
    queries: DataFrame,
    index: Index,
    k: int = search.DEFAULT_K,
    block_bytes: int = search.BLOCK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Also which cells are searched, as (query, cell)."""
    asked = write_stage(search._measurable(queries).select("query_id", "embedding"), "queries")
    asked = asked.select(F.monotonically_increasing_id().alias("query"), "query_id", "embedding")
    asked = write_stage(asked, "queries")
    plain = asked.select("query", "embedding")
    first = _pairs(plain, index, k, True)
    near = write_stage(search._ranked(_searched_cells(first, index, k, block_bytes), k), "hits")
    limits = near.groupBy("query_id").agg(F.max("distance").alias("limit"), F.count("*").alias("n"))
    limits = limits.select(
        F.col("query_id").alias("query"), F.when(F.col("n") >= k, F.col("limit")).otherwise(float("inf")).alias("limit")
    )
    left = plain.join(limits, "query")
    second = _pairs(left, index, k, False)
    more = _searched_cells(second, index, k, block_bytes)
    both = near.select("query_id", "chunk_id", "distance").union(more).withColumnRenamed("query_id", "query")
    named = both.join(asked.select("query", "query_id"), "query").select("query_id", "chunk_id", "distance")
    cells = first.union(second).select(F.col("query_id").alias("query"), "cell")
    return search._ranked(named, k), cells
