import random

import brute
import numpy as np
import pytest
from conftest import SMALL

from docloom.llm import quality_rules

COLUMNS = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()


def bases(rows):
    return [tuple(getattr(r, c) for c in COLUMNS) for r in rows]


def test_base_statistics_of_odd_texts(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t", "a", "a b", "a a a", "a a a a", "x\nx\n\nx \n", "é€😀 #*$%&|<>\x0b\x0c\rz", "\x1fa\xa0b c"]
    texts += ["".join(rng.choice("ab# \n\t") for _ in range(rng.randint(0, 400))) for _ in range(60)]
    texts += ["to be or " * 5000]
    df = spark.createDataFrame([(t, "n", None, i) for i, t in enumerate(texts)], "text string, w string, source string, doc_id long").selectExpr("*", "cast(null as string) as lang")
    got = quality_rules.statistics(df).orderBy("doc_id").collect()
    assert bases(got) == [brute.base_statistics(t) for t in texts]


def test_tables(spark):
    df = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(SMALL.replace("0.001", "0.01") + "/labels.parquet").collect()}
    got = {r.doc_id: r for r in quality_rules.verdicts(df).collect()}
    for r in df.collect():
        assert bases([got[r.doc_id]]) == [brute.base_statistics(r.text)]
    judged = [(labels[i], r.kept) for i, r in got.items() if i in labels and not r.base_failed]
    assert all(not r.kept for r in got.values() if r.base_failed)
    assert np.mean([k for q, k in judged if q == 1]) > 0.98
    assert np.mean([k for q, k in judged if q == 0]) < 0.1


def test_small_groups_nulls_and_empty_table(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, None, None), (1, text, None, None), (None, text + " x", "en", None), (2, None, "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = sorted((str(r.doc_id), r.n_words, r.kept) for r in quality_rules.verdicts(df).collect())
    assert got == [("1", 60, True), ("1", 60, True), ("2", 0, False), ("None", 61, True)]
    assert quality_rules.verdicts(df.limit(0)).collect() == []


def test_distances_are_mahalanobis(spark):
    rng = np.random.default_rng(1)
    points = rng.standard_normal((500, 5)) @ rng.standard_normal((5, 5))
    rows = [("g", "h", *map(float, p)) for p in points]
    df = spark.createDataFrame(rows, "g_lang string, g_source string, x0 double, x1 double, x2 double, x3 double, x4 double")
    estimate = quality_rules._estimate(df).selectExpr("*", "1L as members")
    got = quality_rules._with_distance(df, estimate).toPandas()
    scatter = np.cov(points.T, bias=True) + np.eye(5) * quality_rules._FLOOR**2
    centred = got[["x0", "x1", "x2", "x3", "x4"]].to_numpy() - points.mean(axis=0)
    expected = np.einsum("ij,jk,ik->i", centred, np.linalg.inv(scatter), centred)
    assert got["distance"].to_numpy() == pytest.approx(expected, rel=1e-6)


def test_a_small_language_is_judged_against_its_own(spark):
    rng = random.Random(6)

    def text(chars, end=""):
        return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(chars - 2, chars + 2))) for _ in range(rng.randint(60, 200))) + end

    rows = [(i, text(5), "en", "web") for i in range(300)]
    rows += [(1000 + i, text(30), "th", "web") for i in range(40)]
    rows += [(2000, text(30, " " + "#" * 9000), "th", "web")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality_rules.verdicts(df).collect()}
    assert not got.pop(2000) and all(got.values())


def test_a_salted_join_of_the_groups_gives_the_same(spark, monkeypatch):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    expected = {r.doc_id: r for r in quality_rules.verdicts(df).collect()}
    monkeypatch.setattr(quality_rules, "BROADCAST_BYTES", -1)
    got = {r.doc_id: r for r in quality_rules.verdicts(df).collect()}
    assert got.keys() == expected.keys()
    for i, r in got.items():
        assert (r.kept, r.base_failed) == (expected[i].kept, expected[i].base_failed)
        if not r.base_failed:
            assert r.distance == pytest.approx(expected[i].distance, rel=1e-6)
