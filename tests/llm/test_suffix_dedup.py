import random

import brute
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from docloom.llm import rolling, suffix_dedup


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def corpus(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(60, 300))) for _ in range(8)]
    docs = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("ab ") for _ in range(rng.randint(0, 200))) for _ in range(rng.randint(0, 6))]
        docs.append((i, "".join(parts)))
    docs += [(60, None), (61, ""), (62, "x" * 99), (63, "x" * 100), (64, "x" * 500), (65, "ab" * 400), (66, docs[5][1])]
    return docs


@pytest.mark.parametrize("hot", [0, 3, 2000])
def test_random_texts(spark, hot):
    docs = corpus(hot)
    expected = {k: (v[0], v[1], v[2], v[3]) for k, v in brute.suffix_dedup(docs).items()}
    df = frame(spark, docs)
    got = suffix_dedup.remove_repeats(df, hot_words=hot).collect()
    assert {r.doc_id: (r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in got} == {
        k: v[1:] for k, v in expected.items()
    }


def test_table(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert result(suffix_dedup.digests(df)) == brute.suffix_dedup(docs)


def test_long_text_in_slices(spark, monkeypatch):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    long = "".join(rng.choice("abcdefgh ") for _ in range(30_000)) + passage + passage[:500]
    docs = [(0, passage), (1, long), (2, long[1000:9000] + "z")]
    batch = __import__("pyarrow").array([d[1].encode() for d in docs])
    whole = [len(r.data) for r in rolling.rounds(batch, 200, 1 << 20)]
    cut = list(rolling.rounds(batch, 200, 4096))
    assert len(whole) == 1 and len(cut) > 8
    places = [set(), set()]
    for found, size in zip(places, (1 << 20, 4096)):
        for r in rolling.rounds(batch, 200, size):
            text, trigger, word, place, _, _ = suffix_dedup._parse_round(r)
            found.update(zip(r.row[text], place + r.shift[text], trigger, word))
    assert places[0] == places[1]


def test_nulls_repeated_rows_and_other_columns(spark):
    text = "the same passage, " * 10
    rows = [(None, text, "a", 7), (1, text, None, 7), (1, text, None, 7), (2, text, "b", None), (2, None, "b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, doc long")
    got = sorted((str(r.doc_id), r.doc, r.n_removed) for r in suffix_dedup.remove_repeats(df).collect())
    inner = len(text) - 18  # what repeats within one text
    assert got == sorted([("None", 7, inner), ("1", 7, len(text)), ("1", 7, len(text)), ("2", None, len(text)), ("2", None, 0)])


def test_empty_table(spark):
    assert suffix_dedup.digests(frame(spark, [])).collect() == []


def test_documents_keep_their_columns(spark):
    passage = "é" + "repeated passage of some length " * 5
    rows = [(1, passage + "ü", "en", "s", 3), (2, "x" + passage, None, None, None), (3, None, "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in suffix_dedup.without_repeats(df).collect()}
    assert suffix_dedup.without_repeats(df).columns == df.columns
    assert out[2].text.startswith("x") and len(out[2].text) == out[2].n_chars < 10
    assert out[3].text is None and out[3].lang == "en"


def test_many_equal_rows_and_clashing_columns(spark):
    names = ["kept", "n_removed", "n_spans", "_null", "is_null", "others", "doc", "mark", "data", "row", "spans", "a.b"]
    text = "".join(f"{i} passage of the text, " for i in range(60))
    df = spark.range(3000).select(
        (F.col("id") % 2).alias("doc_id"),
        F.when(F.col("id") % 100 < 98, F.lit(text)).alias("text"),
        *[F.concat(F.lit(n), F.col("id") % 3).alias(n) for n in names],
    )
    out = suffix_dedup.without_repeats(df)
    assert out.columns == df.columns
    # the later document loses all of the text, in every row
    found = {(r.doc_id, r.text): r.n for r in out.groupBy("doc_id", "text").agg(F.count("*").alias("n")).collect()}
    assert found == {(0, text): 1470, (1, ""): 1470, (0, None): 30, (1, None): 30}
    for n in names:
        assert {r[0] for r in out.select(f"`{n}`").distinct().collect()} == {f"{n}{k}" for k in range(3)}
