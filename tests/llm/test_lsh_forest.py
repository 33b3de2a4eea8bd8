import random

import brute
import pytest
from conftest import SMALL

from docloom.llm import components, lsh_forest


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("sf, ids", [("sf0.001", 0), ("sf0.001", 1 << 21), ("sf0.01", 1 << 21)])
def test_table(spark, monkeypatch, sf, ids):
    monkeypatch.setattr(lsh_forest, "BROADCAST_IDS", ids)
    df = spark.read.parquet(SMALL.replace("sf0.001", sf) + "/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert result(lsh_forest.near_duplicates(df)) == brute.near_duplicates(docs)


def test_large_group_of_near_copies(spark):
    rng = random.Random(11)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
    docs = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(200)] = f"x{rng.random()}"
        docs.append((i, " ".join(words)))
    docs += [(400 + i, docs[3][1].upper()) for i in range(50)]
    docs += [(500, None), (501, ""), (502, " \n"), (503, "a B"), (504, "A b"), (505, "a b c d e"), (506, "a b c d f")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert result(lsh_forest.near_duplicates(df)) == brute.near_duplicates(docs)


def test_nulls_repeated_rows_and_other_columns(spark):
    text = "one two three four five six seven"
    rows = [(4, text, "x", 1), (4, text, "x", 1), (None, text, None, 2), (9, text, "y", 3), (None, "alone here", None, 4), (2, None, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, doc long")
    out = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in lsh_forest.near_duplicates(df).collect())
    assert out == [("2", 0, "2", True), ("4", 3, "4", True), ("4", 3, "4", True), ("9", 3, "4", False), ("None", 1, "None", True), ("None", 3, "4", False)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lsh_forest.near_duplicates(df).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(300, 340)] + [(7, 7), (339, 150), (900, 800), (800, 700)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components.components(df).collect()}
    assert set(got) == set(range(100, 161)) | {5} | set(range(300, 340)) | {700, 800, 900}
    assert all(c == (700 if n >= 700 else 5) for n, c in got.items())


def test_links_inside_a_large_family_on_one_template(spark):
    base = [f"t{i}" for i in range(600)]

    def page(i, pair):
        # pages of similarity 0.840; the four words of a pair raise its to 0.851
        return base[:100] + [f"p{pair}_{k}" for k in range(4)] + [f"u{i}_{k}" for k in range(44)] + base[148:]

    pair = {i: 2000 + i // 2 if i < 80 else i for i in range(2000)}
    docs = [(i, " ".join(page(i, pair[i]))) for i in range(2000)]
    expected = {i: i - i % 2 if i < 80 else i for i in range(2000)}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {i: c for i, (_, c, _) in result(lsh_forest.near_duplicates(df)).items()}
    assert got == expected
