import random

import brute
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from docloom.llm import decontaminate


def found(rows):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows}


def test_table(spark):
    folder = SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    got = found(decontaminate.digests(docs, items).collect())
    expected = brute.decontaminate([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == expected
    assert any(x[4] for x in got.values()) and not all(x[4] for x in got.values())


@pytest.mark.parametrize("seed", range(6))
def test_random_words_with_short_and_overlapping_items(spark, seed):
    rng = random.Random(seed)

    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice("ab" if seed % 2 else "abcdef") for _ in range(n))

    items = [(i, text(rng.choice([0, 1, 2, 3, 4, 9, 10, 11, 30])) if i % 4 else "q " * i) for i in range(25)]
    docs = [(i, text(rng.randrange(200))) for i in range(40)]
    docs += [(100 + i, "x " + items[i][1] + " q") for i in range(25)] + [(200, None), (201, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame(items, "item_id long, text string")
    expected = brute.decontaminate(docs, items)
    assert found(decontaminate.digests(d, t).collect()) == expected
    if seed < 2:  # in several blocks
        n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
        blocks = decontaminate.hits(d, t, table_bytes=100)
        got = blocks.select("row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").alias("n")).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.n) for r in got} == {i: x[:3] for i, x in expected.items()}


def test_long_items_and_texts_are_cut_without_loss(spark, monkeypatch):
    words = [f"w{i}" for i in range(20_000)]
    items = [(1, " ".join(words[:9000])), (2, "z " * 300_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[4080:4110])), (3, "z " * 900_000), (4, "y" * 3_000_000)]
    got = found(decontaminate.digests(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect())
    assert [got[i][:3] for i in (1, 2, 3, 4)] == [(20_000, 9000, 1), (30, 30, 1), (900_000, 900_000, 1), (1, 0, 0)]


def test_odd_rows(spark):
    ten = "one two three four five six seven eight nine ten"
    rows = [(1, f"x {ten.upper()} y", "i", 1)] * 300 + [(None, ten, "j", 2), (2, None, None, None), (3, "", "k", 3), (4, ten[:-4], "l", 4), (1, "short item", "m", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, items string, n_words int")
    bench = [(5, ten), (40, ten + " z"), (None, "short item"), (40, ten), (6, None), (7, " ."), (5, "never there")]
    items = spark.createDataFrame(bench, "item_id long, text string").withColumn("part", F.lit(1))
    got = decontaminate.digests(docs, items).collect()
    assert len(got) == 305
    assert sorted((r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got if r.n_words == 12) == [(12, 10, 2, brute.sha(b"40,5"))] * 300
    rest = {(r.doc_id, r.n_words): (r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got if r.n_words != 12}
    none = (0, 0, brute.sha(b""), False)
    assert rest == {(None, 10): (10, 2, brute.sha(b"40,5"), True), (2, 0): none, (3, 0): none, (4, 9): none, (1, 2): (2, 1, brute.sha(b""), True)}
    clean = decontaminate.without_contaminated(docs, items)
    assert clean.columns == docs.columns and sorted(r.n_words or 0 for r in clean.collect()) == [0, 3, 4]
    assert decontaminate.digests(docs.limit(0), items).collect() == []
    assert not any(r.contaminated for r in decontaminate.digests(docs, items.limit(0)).collect())
    blocks = decontaminate.hits(docs, items, table_bytes=20).collect()
    assert len(blocks) == 305 and sum(bool(r["spans"]) for r in blocks) == 302


def test_clean_texts_are_mostly_passed_by():
    table = decontaminate.Table(10)
    table.add([b"w%d" % i for i in range(50)], 0)
    looked = []

    class Shift(bytearray):
        def __getitem__(self, at):
            looked.append(at)
            return bytearray.__getitem__(self, at)

    table.shift = Shift(table.shift)
    assert list(table.occurrences([b"v%d" % i for i in range(10_000)], 0)) == []
    assert len(looked) < 10_000 / 7
