import brute
import pytest
from conftest import SMALL

from docloom.llm import byte_words, importance


def found(rows):
    return {r.doc_id: (r.n_features, r.weight, r.score, r.rank) for r in rows}


def test_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = found(importance.digests(docs.repartition(5), items).collect())
    expected = brute.importance([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in items.collect()])
    assert got == expected
    assert sum(x[3] is not None for x in got.values()) >= 5


@pytest.mark.parametrize("size", [1, 7, 50, 1 << 20])
def test_slices_hold_every_run_once(size):
    text = ("Ab,c 12 é\x7fz \xa0x " * 40 + "y" * 90 + " end").encode()
    words, runs = byte_words.words(text), []
    for part, carried in byte_words.slices(text, 2, size):
        assert all(part[:carried]) and carried <= 2
        runs += [tuple(part[i : i + 3]) for i in range(max(0, carried - 2), len(part) - 2)]
    assert runs == [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    assert [w.decode() for w in words] == brute.byte_words(text.decode())


def test_long_text_in_slices(spark, monkeypatch):
    text = " ".join(f"w{i % 977}x" for i in range(5000))
    docs = [(1, text), (2, "a b"), (3, None)]
    whole = found(importance.digests(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("w1x w2x",)], "text string")).collect())
    assert whole == brute.importance(docs, ["w1x w2x"])
    sliced = [importance._bucketed(text.encode(), 10_000)]
    monkeypatch.setattr(byte_words.slices, "__defaults__", (100,))
    sliced.append(importance._bucketed(text.encode(), 10_000))
    counts = []
    for parts in sliced:
        n, buckets = 0, []
        for n_words, b in parts:
            n, buckets = n + n_words, buckets + b.tolist()
        counts.append((n, sorted(buckets)))
    assert counts[0] == counts[1]


def test_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(7, text, 1, "r", 2)] * 60 + [(None, text, 1, None, 0), (3, None, 0, "s", 1), (4, "", 0, "t", 1), (5, " \n", 0, "u", None), (6, text + " zz", 0, "v", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, row string, n_words int")
    items = spark.createDataFrame([(1, "Word3 WORD4"), (2, None)], "item_id long, text string")
    got = importance.digests(docs.repartition(3), items).collect()
    assert len(got) == 65
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len({r[1:4] for r in map(tuple, by_id[7])}) == 1
    # 5 % of the 62 documents of 20 words
    assert sorted(r.rank for r in got if r.rank) == [1, 2, 3]
    best = sorted(got, key=lambda r: (-r.score, r.doc_id is not None, r.doc_id or 0))
    assert {r.score for r in got if r.rank} == {r.score for r in [b for b in best if b.n_features > 57][:3]}
    assert all((by_id[i][0].n_features, by_id[i][0].weight, by_id[i][0].rank) == (0, 0, None) for i in (3, 4, 5))
    drawn = importance.resample(docs, items)
    assert drawn.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in drawn.collect()))) == sorted(str(r.doc_id) for r in got if r.rank)
    assert importance.digests(docs.limit(0), items).collect() == []
    alone = importance.digests(docs, items.limit(0)).collect()
    assert len(alone) == 65 and importance.resample(docs.limit(0), items).collect() == []


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(importance, "noise", lambda *_: F.lit(0).cast("long"))
    text = " ".join("abcdefghijklmnopqrstuvwxyz")
    docs = spark.createDataFrame([(i, text) for i in range(99, -1, -1)], "doc_id long, text string")
    got = importance.digests(docs, docs.limit(1)).where("rank is not null").orderBy("rank").collect()
    assert [(r.rank, r.doc_id) for r in got] == [(i + 1, i) for i in range(5)]
