"""Exact nearest neighbours of a batch of query vectors."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docloom.functions import text
from docloom.functions.vectors import similarity
from docloom.operators.collection import Embed
from docloom.shared import write_stage

# Fixed values.
DEFAULT_K = 5
SAMPLE_K = 3
UNKNOWN = "Unknown"

# Cells of the query x row matrix computed at once: 16 MB.
MATRIX_CELLS = 1 << 21
# Vectors travel packed in rows of about this size.
PACK_BYTES = 2 << 20
# Queries up to this size meet the collection where it lies; more go in groups of this size.
BLOCK_BYTES = 32 << 20
# A task lets go of its best hits beyond this number; a group of queries has no more of them.
HELD_HITS = 1 << 19
# More parts of the grid for each core than this would only move the queries more often.
PARTS_PER_CORE = 4


def nearest_single(
    vector: list[float], collection: DataFrame, k: int = DEFAULT_K, exclude_missing: bool = False
) -> DataFrame:
    """The ``k`` rows nearest to one vector: each task keeps its best k, then a merge."""
    if not np.isfinite(np.asarray(vector, dtype=np.float64)).all():
        raise ValueError("the query vector has components that aren't finite")
    asked = collection.sparkSession.createDataFrame(
        [(0, [float(x) for x in vector])], "query_id int, embedding array<double>"
    )
    found = _met(asked, _searched(collection, exclude_missing), k, 1)
    return found.select("chunk_id", "distance").orderBy("distance", "chunk_id").limit(k)


def _finite(vector: str) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _measurable(rows: DataFrame) -> DataFrame:
    """Rows that can be at a distance: without a vector, or with a component that is null or
    not finite, a row is left out, so that it can't hide the rows beside it."""
    return rows.where(F.coalesce(_finite("embedding") & (F.size("embedding") > 0), F.lit(False)))


def _searched(collection: DataFrame, exclude_missing: bool) -> DataFrame:
    rows = collection.where("not embedding_missing") if exclude_missing else collection
    return _measurable(rows).select("chunk_id", "embedding")


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("distance", "chunk_id")
    return (
        candidates.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "chunk_id", "distance")
    )


def _nearest_rows(
    queries: np.ndarray, rows: np.ndarray, squares: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs that hold, for each query, all rows that may be its k nearest.

    ``squares`` are those of the rows. The matrix product rounds, so rows within its
    error of the k-th stay in.
    """
    own = (queries**2).sum(1)[:, None]
    rough = own + squares[None, :] - 2.0 * (queries @ rows.T)
    if rows.shape[0] <= k:
        return np.nonzero(np.ones_like(rough, dtype=bool))
    slack = 1e-9 * (1.0 + own + squares.max())
    limit = np.partition(rough, k - 1, axis=1)[:, k - 1 : k]
    return np.nonzero(rough <= limit + slack)


def _best(queries: np.ndarray, rows: np.ndarray, chunk_ids: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest rows of each query, named by its place."""
    squares = (rows**2).sum(1)
    step = max(1, MATRIX_CELLS // len(rows))
    found = []
    for begin in range(0, len(queries), step):
        part = queries[begin : begin + step]
        which, row = _nearest_rows(part, rows, squares, k)
        # exact distances, summed from small differences, of the few pairs left
        exact = ((part[which] - rows[row]) ** 2).sum(1)
        columns = {"query": begin + which, "chunk_id": chunk_ids[row], "distance": exact}
        found.append(_keep(pd.DataFrame(columns), k))
    return pd.concat(found)


def _keep(found: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = found.sort_values(["query", "distance", "chunk_id"], kind="stable")
    return ordered.groupby("query", sort=False).head(k)


_PACK = "width int, cell int, ids array<{}>, data binary"


def _pack(
    batches: Iterator[pa.RecordBatch], dtype: str, size: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Lay the vectors of one width and cell end to end, about ``size`` bytes of them in a row."""
    held: dict[tuple[int, int], tuple[list, list]] = {}
    for batch in batches:
        widths = pc.list_value_length(batch.column("embedding")).to_numpy(zero_copy_only=False)
        cells = batch.column("cell").to_numpy(zero_copy_only=False)
        for width, cell in np.unique(np.stack([widths, cells], 1), axis=0).tolist():
            mine = batch.filter(pa.array((widths == width) & (cells == cell)))
            values = mine.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
            ids, data = held.setdefault((width, cell), ([], []))
            most = max(1, size // (width * values.itemsize))
            for begin in range(0, mine.num_rows, most):
                ids.append(mine.column(0).slice(begin, most))
                data.append(values[begin * width : (begin + most) * width])
                if sum(map(len, ids)) >= most:
                    yield _one_pack(width, cell, ids, data, schema)
                    ids.clear()
                    data.clear()
    for (width, cell), (ids, data) in held.items():
        if ids:
            yield _one_pack(width, cell, ids, data, schema)


def _one_pack(width: int, cell: int, ids: list, data: list, schema: pa.Schema) -> pa.RecordBatch:
    joined = pa.concat_arrays(ids)
    offsets = pa.array([0, len(joined)], pa.int32())
    columns = [
        pa.array([width], pa.int32()),
        pa.array([cell], pa.int32()),
        pa.ListArray.from_arrays(offsets, joined),
        pa.array([np.concatenate(data).tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=schema.names)


def _packs(rows: DataFrame, names: tuple[str, str], dtype: str) -> DataFrame:
    """The vectors of ``rows`` (id, embedding, cell), packed where they lie."""
    id_type = rows.schema.fields[0].dataType
    schema = T.StructType.fromDDL(_PACK.format(id_type.simpleString()))
    run = partial(_pack, dtype=dtype, size=PACK_BYTES, schema=to_arrow_schema(schema))
    packed = rows.mapInArrow(run, schema)
    return packed.select(
        "width",
        "cell",
        F.col("ids").alias(names[0]),
        F.col("data").alias(names[1]),
        F.monotonically_increasing_id().alias(f"{names[1]}_number"),
    )


def _scan(
    batches: Iterator[pa.RecordBatch], k: int, dtype: str, asked_dtype: str, most: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """The best k of the rows that a task sees, for each block of queries that it sees."""
    held: dict[int, tuple[pa.Array, pd.DataFrame]] = {}
    slab = rows = chunk_ids = None
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        for i in range(batch.num_rows):
            width, number = columns["width"][i].as_py(), columns["rows_number"][i].as_py()
            if number != slab:
                slab, data = number, columns["rows"][i].as_buffer()
                rows = np.frombuffer(data, dtype).reshape(-1, width).astype(np.float64)
                chunk_ids = np.asarray(columns["chunk_ids"][i].values.to_pylist(), dtype=object)
            block = columns["queries_number"][i].as_py()
            queries = np.frombuffer(columns["queries"][i].as_buffer(), asked_dtype).reshape(-1, width)
            queries = queries.astype(np.float64, copy=False)
            found = _best(queries, rows, chunk_ids, k)
            if block in held:
                found = _keep(pd.concat([held[block][1], found]), k)
            held[block] = (columns["query_ids"][i].values, found)
        if sum(len(best) for _, best in held.values()) > most:
            yield from _let_go(held, schema)
            held.clear()
    yield from _let_go(held, schema)


def _let_go(held: dict[int, tuple[pa.Array, pd.DataFrame]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for ids, best in held.values():
        columns = [
            ids.take(pa.array(best["query"].to_numpy())),
            pa.array(best["chunk_id"], pa.string()),
            pa.array(best["distance"], pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)


def _hit_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", id_type),
            T.StructField("chunk_id", T.StringType()),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def _dtype(rows: DataFrame) -> str:
    """How the vectors of a table are packed: floats as they are, anything else as doubles."""
    return "f4" if rows.schema["embedding"].dataType.elementType == T.FloatType() else "f8"


def _groups(asked: DataFrame, k: int, block_bytes: int) -> int:
    """Into how many groups queries go, each of about ``block_bytes`` and ``HELD_HITS`` hits."""
    width = np.dtype(_dtype(asked)).itemsize
    size, count = asked.agg(F.sum(width * F.size("embedding")), F.count(F.lit(1))).first()
    return max(1, -(-(size or 0) // block_bytes), -(-count * k // HELD_HITS))


def _met(asked: DataFrame, rows: DataFrame, k: int, groups: int) -> DataFrame:
    """The best k of each share of the collection, for every query.

    Both sides are packed where they lie; queries meet the rows of their cell, where they
    have cells. One group of queries is broadcast by the join, and the rows stay; more of them
    meet the rows in a grid, so that a part of it holds one group while the rows of its share
    stream past. The grid has parts for all cores and no more: each query moves to every share,
    each row to every group.
    """
    asked, rows = (x if "cell" in x.columns else x.withColumn("cell", F.lit(0)) for x in (asked, rows))
    id_type = asked.schema["query_id"].dataType
    dtype, asked_dtype = _dtype(rows), _dtype(asked)
    slabs = _packs(rows.select("chunk_id", "embedding", "cell"), ("chunk_ids", "rows"), dtype)
    blocks = _packs(asked.select("query_id", "embedding", "cell"), ("query_ids", "queries"), asked_dtype)
    if groups == 1:
        pairs = slabs.join(F.broadcast(blocks), ["width", "cell"])
    else:
        spark = rows.sparkSession
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        shares = -(-min(partitions, PARTS_PER_CORE * spark.sparkContext.defaultParallelism) // groups)

        def dealt(number: str, count: int) -> Column:
            return F.pmod(F.xxhash64(number), F.lit(count)).cast("int")

        def every(count: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

        slabs = slabs.withColumn("share", dealt("rows_number", shares)).withColumn("group", every(groups))
        blocks = blocks.withColumn("group", dealt("queries_number", groups)).withColumn("share", every(shares))
        pairs = slabs.join(blocks, ["width", "cell", "share", "group"])
    schema = _hit_schema(id_type)
    run = partial(
        _scan, k=k, dtype=dtype, asked_dtype=asked_dtype, most=HELD_HITS, schema=to_arrow_schema(schema)
    )
    return pairs.mapInArrow(run, schema)


def nearest(
    queries: DataFrame,
    collection: DataFrame,
    k: int = DEFAULT_K,
    exclude_missing: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(query_id, embedding) x collection -> (query_id, rank, chunk_id, distance).

    One join whatever the number of queries. Up to ``block_bytes`` of them, with ``HELD_HITS``
    hits, are broadcast and the collection doesn't move; more are dealt out into groups of about that
    size. Each task
    keeps the best k of its rows per query, and a second step those of all tasks. A query
    whose vector is null, or has a component that is null or not finite, has no hits;
    neither has one of another width than all stored vectors.
    """
    asked = write_stage(_measurable(queries).select("query_id", "embedding"), "queries")
    groups = _groups(asked, k, block_bytes)
    return _ranked(_met(asked, _searched(collection, exclude_missing), k, groups), k)


def search_texts(
    queries: DataFrame,
    collection: DataFrame,
    embed: Embed,
    k: int = DEFAULT_K,
    exclude_missing: bool = False,
) -> DataFrame:
    """(query_id, query) -> ranked hits, the texts being embedded as the documents were.

    A query that can't be embedded is an error: its zero vector would have hits that
    mean nothing.
    """
    embedded = write_stage(
        embed(queries.select("query_id", F.col("query").alias("document"))), "query-vectors"
    )
    failed = embedded.where("embedding_missing").select("query_id").take(5)
    if failed:
        raise ValueError(f"queries without an embedding: {[r.query_id for r in failed]}")
    return nearest(embedded, collection, k, exclude_missing)


def display_columns(document: Column, metadata: Column, distance: Column) -> list[Column]:
    return [
        F.coalesce(metadata["source_file"], F.lit(UNKNOWN)).alias("source"),
        F.coalesce(metadata["full_path"], F.lit(UNKNOWN)).alias("path"),
        text.preview(document).alias("preview"),
        similarity(distance).alias("similarity"),
    ]


def hydrate(hits: DataFrame, collection: DataFrame) -> DataFrame:
    """Ranked hits with document, metadata, preview and similarity."""
    stored = collection.select("chunk_id", "document", "metadata")
    return hits.join(stored, "chunk_id").select(
        "query_id",
        "rank",
        "chunk_id",
        "document",
        "metadata",
        "distance",
        *display_columns(F.col("document"), F.col("metadata"), F.col("distance")),
    )
