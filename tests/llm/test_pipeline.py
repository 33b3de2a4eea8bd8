import brute
import corpus_pipeline
import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as registered
from docloom.llm import queries
from docloom.llm.common import stage


def test_statements(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        found = con.execute(sql)
        columns = [c[0] for c in found.description]
        df = registered.queries()[name](spark, SMALL)
        assert sorted(df.columns) == sorted(columns)
        assert sorted(map(repr, found.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES:
        after = stage(function(spark, docs, SMALL), name)
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns
    (raw, good), (_, single), (_, cut), (_, mixed), (_, coded) = stages
    assert set(texts(good)) < set(texts(raw))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    gone = {i for i, _ in texts(raw)} - {i for i, _ in texts(good)}
    assert sum(labels.get(i) == 1 for i in gone) == 0
    kept = {i for i, (_, _, k) in brute.near_duplicates(texts(good)).items() if k}
    assert {i for i, _ in texts(single)} == kept
    removed = brute.suffix_dedup(texts(single))
    sizes = {i: len((t or "").encode()) for i, t in texts(cut)}
    assert all(abs(sizes[i] - (n - r)) <= 6 * s + 6 for i, (n, r, s, _) in removed.items())
    assert {i for i, _ in texts(mixed)} <= set(sizes)
    assert len(texts(mixed)) == coded.count() and "ids" in coded.columns


def test_run_is_the_stages_in_a_row(spark, stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and registered.queries()["pipeline"] is corpus_pipeline.run
    got = corpus_pipeline.run(spark, SMALL).select("doc_id", "ids")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, stages[-1][1].select("doc_id", "ids").collect()))
