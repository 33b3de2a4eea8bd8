import numpy as np
import pytest
from conftest import SMALL

from docloom.llm import nearest


def brute(rows, k=nearest.K):
    out = {}
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], float)
    for i, v in rows:
        if i % nearest.EVERY == 0:
            scores = matrix @ np.array(v, float)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, expected):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in e}) for q, e in expected.items())
    return hits / sum(map(len, expected.values()))


def test_table(spark):
    df = spark.read.parquet(SMALL.replace("0.001", "0.1") + "/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, expected = found(nearest.neighbours(df)), brute(rows)
    assert set(got) == set(expected) and all(len(v) == 20 for v in got.values())
    assert recall(got, expected) >= 0.95
    exact = {q: dict(v) for q, v in got.items()}
    by_id = {i: np.array(v, float) for i, v in rows}
    for q, v in exact.items():
        for i, s in v.items():
            assert s == pytest.approx(float(by_id[q] @ by_id[i]), abs=1e-12)


def test_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SHARD_ROWS", 300)
    monkeypatch.setattr(nearest, "BLOCK_QUERIES", 20)
    rng = np.random.default_rng(2)
    same = rng.standard_normal(16)
    rows = [(i, (same if i % 3 == 0 else rng.standard_normal(16) * rng.uniform(0.1, 3)).tolist()) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, expected = found(nearest.neighbours(df)), brute(rows)
    assert set(got) == set(expected)
    assert recall(got, expected) >= 0.9


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, None, 2), (2, [0.0, 0.0], 2), (3, [nan, 1.0], 2), (4, [inf, 1.0], 2), (5, [None, 1.0], 2), (6, [], 2), (7, [2.0, 1.0], 2), (8, [2.0, -1.0], 2), (9, [1.0], 2), (None, [5.0, 5.0], 2), (20, None, 1), (40, [1.0], None), (10, [-1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    assert found(nearest.neighbours(df)) == {0: [(7, 2.0), (8, 2.0), (10, -1.0)], 40: [(9, 1.0)]}
    assert nearest.neighbours(df.limit(0)).collect() == []


def test_quantile():
    assert nearest.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
