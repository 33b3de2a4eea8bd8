import random

import brute
import pyarrow as pa
import pytest
from conftest import SMALL

from docloom.llm import rolling, window_dedup


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 4)))
    passages = [[word() for _ in range(rng.randint(30, 90))] for _ in range(8)]
    docs = []
    for i in range(80):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += rng.choice(passages) if rng.random() < 0.5 else [word() for _ in range(rng.randint(0, 30))]
        docs.append((i, "".join(w + rng.choice([" ", "\n", "\t ", "\x0b"]) for w in words)))
    return docs + [(80, None), (81, ""), (82, "x " * 35), (83, "x " * 36), (84, "y " * 36), (85, "ab ba " * 60), (86, docs[5][1]), (87, " ".join("abc"))]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in window_dedup.digests(df).collect()}
    assert got == brute.window_dedup(docs)


def test_table(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in window_dedup.digests(df).collect()}
    assert got == brute.window_dedup(docs)


def test_cover_meets_every_shift():
    for shift in range(window_dedup.PERIOD):
        assert any((c + shift) % window_dedup.PERIOD in window_dedup.COVER for c in window_dedup.COVER)


def test_words_of_long_texts_are_not_cut():
    text = (" ab" * 700 + "x" * 5000 + " \t" + "yz " * 900).encode()
    column = pa.array([b"a b", text, b"", b"c"])
    found = {}
    for size in (1 << 20, 256):
        words = []
        for w in rolling.words(column, size):
            for row, b, e in zip(w.row, w.begin, w.end):
                words.append((row, list(w.hashes[b:e])))
        found[size] = words
    assert found[256] == found[1 << 20]
    assert [len(w) for _, w in found[256]] == [2, len(text.split()), 0, 1]


def test_nulls_repeated_rows_and_other_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "k"), (1, text, "k"), (2, None, None), (None, "z", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in window_dedup.remove_windows(df).collect())
    assert got == [("1", 40, 0), ("1", 40, 0), ("2", 0, 0), ("None", 1, 0)]
    rows += [(None, text, None), (1, "other " + text, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in window_dedup.remove_windows(df).collect())
    assert got == [("1", 40, 40), ("1", 40, 40), ("1", 41, 40), ("2", 0, 0), ("None", 1, 0), ("None", 40, 40)]


def test_empty_table(spark):
    assert window_dedup.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_many_repeated_rows(spark):
    """Each range is collected once, however often its row comes."""
    rng = random.Random(8)
    shared = " ".join(f"s{rng.randint(0, 999)}" for _ in range(60))
    text = " ".join(f"w{rng.randint(0, 9999)}" for _ in range(200)) + " " + shared
    docs = [(1, text)] * 2000 + [(2, shared + " end"), (3, "a " + shared)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {}
    for r in window_dedup.digests(df).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.kept_sha256))
    assert {i: len(v) for i, v in got.items()} == {1: 2000, 2: 1, 3: 1}
    assert all(len(set(v)) == 1 for v in got.values())
    assert {i: v[0] for i, v in got.items()} == brute.window_dedup([(1, text), *docs[2000:]])
