"""Search by cells against the search of everything."""

import re
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_search import collected, direct, query_table, vector_table

from docloom.operators import cells, search


@pytest.fixture(scope="module")
def clustered():
    rnd = np.random.default_rng(8)
    middles = rnd.normal(scale=20, size=(25, 10))
    rows = (middles[rnd.integers(0, 25, 900)] + rnd.normal(size=(900, 10))).astype(np.float32).astype(float)
    rows[600:880] = rows[600]  # many copies
    queries = np.vstack([middles[:8] + rnd.normal(size=(8, 10)), rows[600], np.zeros(10), rnd.normal(scale=60, size=(3, 10))])
    return rows, queries.astype(np.float32).astype(float)


def alike(got, expected):
    """The same rows in the same order, at distances that agree to twelve digits."""
    assert {q: [c for c, _ in hits] for q, hits in got.items()} == {q: [c for c, _ in hits] for q, hits in expected.items()}
    return all(d == pytest.approx(e, rel=1e-12, abs=1e-8) for q in got for (_, d), (_, e) in zip(got[q], expected[q]))


def named():
    return "cells_" + uuid.uuid4().hex


@pytest.mark.parametrize("block_bytes", [400, 1 << 20])
def test_as_the_search_of_everything(spark, clustered, block_bytes):
    rows, queries = clustered
    index = cells.build(vector_table(spark, rows), named(), cells=20, sample=300)
    assert int(index.counts.sum()) == len(rows) == index.rows.count()
    for k in (1, 4, 60):
        hits, searched = cells.nearest_with_cells(query_table(spark, queries), index, k, block_bytes)
        assert alike(collected(hits), direct(queries, rows, k))
        pairs = {(r["query"], r.cell) for r in searched.collect()}
        assert len(pairs) == searched.count()
        scanned = sum(int(index.counts[c]) for _, c in pairs) / (len(queries) * len(rows))
        assert scanned < 0.6 if k < 60 else scanned < 1
    # files of cells that nobody searches are not read
    pairs = query_table(spark, queries[:1]).selectExpr("bigint(query_id) as query_id", "embedding", "3 as cell")
    plan = cells._searched_cells(pairs, index, 2, 1 << 20)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cell#\d+ = 3", plan)


def test_vectors_without_clusters(spark):
    rnd = np.random.default_rng(1)
    rows = rnd.normal(size=(300, 16)).astype(np.float32).astype(float)
    index = cells.build(vector_table(spark, rows), named(), cells=8)
    assert collected(cells.nearest(query_table(spark, rows[:40]), index, 3)) == direct(rows[:40], rows, 3)


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(f"c{i:02d}", [float(i), 0.0]) for i in range(20)] + [("n", [nan, 0.0]), ("z", None), ("s", [3.0]), ("t", [5.0]), ("e", [])]
    stored = spark.createDataFrame(rows, "chunk_id string, embedding array<float>")
    asked = spark.createDataFrame([(1, [0.0, 0.0]), (1, [19.0, 0.0]), (2, None), (3, [4.9]), (4, [0.0] * 5), (None, [7.0, 0.0])], "query_id int, embedding array<float>")
    index = cells.build(stored, named(), cells=5)
    assert collected(cells.nearest(asked, index, 2)) == collected(search.nearest(asked, stored, 2))
    everything = collected(cells.nearest(asked, index, 100))
    assert everything == collected(search.nearest(asked, stored, 100)) and len(everything[None]) == 20
    again = cells.open_index(spark, _last(spark))
    assert collected(cells.nearest(asked, again, 2)) == collected(search.nearest(asked, stored, 2))
    nothing = cells.build(stored.where(F.lit(False)), named())
    assert cells.nearest(asked, nothing, 2).collect() == []
    assert cells.nearest(asked.where(F.lit(False)), index, 2).collect() == []


def _last(spark):
    name = named()
    cells.build(spark.createDataFrame([(f"c{i:02d}", [float(i), 0.0]) for i in range(20)] + [("s", [3.0]), ("t", [5.0])], "chunk_id string, embedding array<float>"), name, cells=5)
    return name
