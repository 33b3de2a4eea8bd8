"""Nearest neighbours against a direct computation."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.functions.vectors import squared_l2
from docloom.operators import collection, search
from docloom.shared import write_stage

VECTORS = "chunk_id string, embedding array<float>, embedding_missing boolean"


def vector_table(spark, matrix, missing=()):
    rows = [(f"c{i:04d}", [float(x) for x in v], i in missing) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, VECTORS).repartition(5)


def query_table(spark, matrix):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "query_id int, embedding array<float>")


def direct(queries, rows, k):
    out = {}
    for q, query in enumerate(queries.astype(np.float32).astype(float)):
        found = ((rows.astype(np.float32).astype(float) - query) ** 2).sum(1)
        order = sorted(range(len(rows)), key=lambda i: (round(found[i], 12), i))[:k]
        out[q] = [(f"c{i:04d}", round(found[i], 9)) for i in order]
    return out


def collected(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.chunk_id, round(r.distance, 9)))
    return out


@pytest.fixture(scope="module")
def data():
    rnd = np.random.default_rng(4)
    rows = rnd.normal(size=(700, 12))
    rows[300:533] = rows[300]  # a third of the rows are copies: ties go by id
    return rows, np.vstack([rnd.normal(size=(9, 12)), rows[300]])


def test_shared_queries(spark, data):
    rows, queries = data
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        hits = search.nearest(query_table(spark, queries), vector_table(spark, rows), 4)
        assert collected(hits) == direct(queries, rows, 4)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("block_bytes", [60, 3 * 12 * 8, 1 << 20])
@pytest.mark.parametrize("pack_bytes", [200, 1 << 20])
def test_queries_and_rows_meet_in_one_join(spark, data, monkeypatch, block_bytes, pack_bytes):
    rows, queries = data
    stored = write_stage(vector_table(spark, rows), "vectors")
    monkeypatch.setattr(search, "PACK_BYTES", pack_bytes)
    hits = search.nearest(query_table(spark, queries).repartition(3), stored, 4, block_bytes=block_bytes)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("(?:BroadcastHash|SortMerge)Join", plan)) == 1 and plan.count("MapInArrow") == 3
    assert not any(x in plan for x in ("CoGroup", "Cartesian", "NestedLoop"))
    if block_bytes == 1 << 20:  # one group of queries: the rows stay where they are
        assert "BroadcastHashJoin" in plan and "hashpartitioning(width" not in plan
    assert collected(hits) == direct(queries, rows, 4)


def test_packs_hold_every_vector_once():
    vectors = [[float(i)] * (3 if i % 4 else 2) for i in range(60)]
    batches = [
        pa.record_batch({
            "id": pa.array(range(b, b + 20)),
            "embedding": pa.array(vectors[b : b + 20], pa.list_(pa.float32())),
            "cell": pa.array([i % 2 for i in range(b, b + 20)], pa.int32()),
        })
        for b in range(0, 60, 20)
    ]
    schema = pa.schema([("width", pa.int32()), ("cell", pa.int32()), ("ids", pa.list_(pa.int64())), ("data", pa.binary())])
    seen = {}
    for pack in search._pack(iter(batches), "f4", 5 * 3 * 4, schema):
        (row,) = pack.to_pylist()
        matrix = np.frombuffer(row["data"], "f4").reshape(-1, row["width"])
        assert {i % 2 for i in row["ids"]} == {row["cell"]}
        assert len(matrix) == len(row["ids"]) and len(row["data"]) <= 5 * 3 * 4 + 3 * 4 * 20
        seen |= {i: v.tolist() for i, v in zip(row["ids"], matrix)}
    assert seen == dict(enumerate(vectors))


def test_every_row_as_a_query(spark, data, monkeypatch):
    """A task that lets go of its hits early, and queries that repeat an id or have none."""
    rows = data[0][:150]
    monkeypatch.setattr(search, "HELD_HITS", 40)
    asked = query_table(spark, rows)
    hits = search.nearest(asked.repartition(6), vector_table(spark, rows), 3, block_bytes=1000)
    assert collected(hits) == direct(rows, rows, 3)
    odd = spark.createDataFrame([(None, [0.0]), (1, [0.0]), (1, [9.0])], "query_id int, embedding array<double>")
    stored = spark.createDataFrame([("a", [1.0]), ("b", [8.5]), ("c", [100.0])], "chunk_id string, embedding array<double>")
    got = collected(search.nearest(odd, stored, 2))
    assert got == {None: [("a", 1.0), ("b", 72.25)], 1: [("b", 0.25), ("a", 1.0)]}


def test_a_query_moves_to_no_more_shares_than_cores_need(spark, data, monkeypatch):
    """A hit for each share and place: the more shares, the more moves."""
    rows, queries = data
    monkeypatch.setattr(search, "PACK_BYTES", 1)  # every row a pack of its own
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        asked = query_table(spark, queries)
        shares = -(-search.PARTS_PER_CORE * spark.sparkContext.defaultParallelism // 2)
        hits = search._met(asked, vector_table(spark, rows), 4, 2)
        assert hits.count() <= len(queries) * 4 * shares
        assert search._groups(asked, 4, 1 << 20) == 1
        assert search._groups(asked, 4, 10 * 12 * 4 // 2) == 2  # floats travel as floats
        monkeypatch.setattr(search, "HELD_HITS", 12)
        assert search._groups(asked, 4, 1 << 20) == 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_rows_that_cannot_be_at_a_distance(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(f"c{i}", [float(i), 0.0]) for i in range(20)]
    rows += [("n", [nan, 0.0]), ("i", [inf, 0.0]), ("s", [0.0]), ("l", [0.0, 0.0, 0.0]), ("z", None), ("y", [None, 0.0])]
    stored = spark.createDataFrame(rows, "chunk_id string, embedding array<float>").coalesce(1)
    asked = [(1, [0.0, 0.0]), (2, None), (3, [nan, 0.0]), (4, [0.0]), (5, []), (6, [0.0] * 5)]
    queries = spark.createDataFrame(asked, "query_id int, embedding array<float>")
    got = collected(search.nearest(queries, stored, 3))
    assert got == {1: [("c0", 0.0), ("c1", 1.0), ("c10", 100.0)][:2] + [("c2", 4.0)], 4: [("s", 0.0)]}
    with pytest.raises(ValueError):
        search.nearest_single([nan, 0.0], stored)


def test_search_by_text(spark):
    def letters(texts):
        if "fail" in texts:
            raise RuntimeError
        return [[float(t.count(c)) for c in "abc"] for t in texts]

    embed = collection.embedder(letters, 3, call_size=2)
    stored = embed(spark.createDataFrame([("x", "aab"), ("y", "bc"), ("z", "ccc")], "chunk_id string, document string"))
    asked = spark.createDataFrame([(1, "baa"), (2, "cc")], "query_id int, query string")
    assert collected(search.search_texts(asked, stored, embed, 1)) == {1: [("x", 0.0)], 2: [("z", 1.0)]}
    with pytest.raises(ValueError, match="without an embedding"):
        search.search_texts(spark.createDataFrame([(1, "fail")], "query_id int, query string"), stored, embed)


def test_single_query(spark, data):
    rows, queries = data
    found = search.nearest_single(queries[0].astype(np.float32).tolist(), vector_table(spark, rows)).collect()
    assert [(r.chunk_id, round(r.distance, 9)) for r in found] == direct(queries, rows, 5)[0]


def test_distance_expression(spark, data):
    rows, queries = data
    wanted = F.lit(queries[1].astype(np.float32).tolist())
    got = vector_table(spark, rows).select(
        "chunk_id", squared_l2(F.col("embedding"), wanted).alias("distance")
    )
    best = got.orderBy("distance", "chunk_id").limit(4).collect()
    assert [(r.chunk_id, round(r.distance, 9)) for r in best] == direct(queries, rows, 4)[1]


def test_fewer_rows_than_k_and_nothing_at_all(spark):
    rows = np.eye(3)
    hits = search.nearest(query_table(spark, rows[:1]), vector_table(spark, rows), 10)
    assert len(collected(hits)[0]) == 3
    none = query_table(spark, rows).limit(0)
    assert search.nearest(none, vector_table(spark, rows)).count() == 0
    assert search.nearest(query_table(spark, rows), vector_table(spark, rows).limit(0)).count() == 0


def test_near_ties_are_told_apart(spark):
    base = np.full((40, 4), 100.0, dtype=np.float64)
    base[:, 0] += np.arange(40)[::-1] * 1e-5
    query = np.full((1, 4), 100.0)
    hits = search.nearest(query_table(spark, query), vector_table(spark, base), 5)
    assert collected(hits) == direct(query, base, 5)


def test_zero_vectors_rank_unless_excluded(spark):
    rows = np.array([[0.0, 0.0], [0.6, 0.8], [0.0, 1.0]])
    table = vector_table(spark, rows, missing={0})
    query = query_table(spark, np.array([[1.0, 0.0]]))
    # against a unit query a zero vector has distance 1, a cosine of 0.6 has 0.8
    assert [c for c, _ in collected(search.nearest(query, table, 2))[0]] == ["c0001", "c0000"]
    kept = search.nearest(query, table, 2, exclude_missing=True)
    assert [c for c, _ in collected(kept)[0]] == ["c0001", "c0002"]


def test_hydrate(spark):
    hits = spark.createDataFrame(
        [(1, 1, "a", 0.25), (1, 2, "b", 1.5)], "query_id int, rank int, chunk_id string, distance double"
    )
    stored = spark.createDataFrame(
        [("a", "d" * 250, ("f.json", "P > Q")), ("b", "short", None)],
        "chunk_id string, document string, metadata struct<source_file:string,full_path:string>",
    )
    first, second = search.hydrate(hits, stored).orderBy("rank").collect()
    assert (first.source, first.path, first.similarity) == ("f.json", "P > Q", 0.75)
    assert first.preview == "d" * 200 + "..." and second.preview == "short..."
    assert (second.source, second.path, second.similarity) == ("Unknown", "Unknown", -0.5)
    assert first.document == "d" * 250


def test_queries_travel_and_the_collection_stays(spark, data):
    rows, queries = data
    stored = vector_table(spark, rows).withColumn("document", F.lit("d")).withColumn(
        "metadata", F.lit(None).cast("struct<source_file:string,full_path:string>")
    )
    hits = search.nearest(query_table(spark, queries), stored, 3)
    plan = search.hydrate(hits, stored)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
