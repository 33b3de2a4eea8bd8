import re
import struct

import brute
import pytest
import xxhash
from conftest import SMALL
from pyspark.sql import functions as F

from docloom.llm import mixing


def level_targets(sizes):
    """Shares by weight; what is above a source's most is shared again by the others."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] > 2 * sizes[s]}
        if not full:
            return out | {s: level * weights[s] for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_table(spark):
    df = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/documents.parquet")
    texts = {r.doc_id: r for r in df.collect()}
    got = mixing.shares(df).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in mixing.shares(df.repartition(7)).collect())
    sizes, taken = {}, {}
    for r in got:
        s = texts[r.doc_id].source
        assert r.size == len(brute.WORD.findall(texts[r.doc_id].text or ""))
        assert 0 <= r.taken <= 2 * r.size
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
    targets = level_targets(sizes)
    for r in got:
        s = texts[r.doc_id].source
        assert r.source_size == sizes[s] and r.target == pytest.approx(targets[s], rel=1e-9)
    assert len(got) == len(texts)
    assert all(abs(taken[s] - targets[s]) <= mixing.BLOCK for s in sizes)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 300}, {"a": 7}, {"a": 0, "b": 5}, {"a": 0}, {"z": 100, "é": 100, "A": 100, "": 1}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    expected = level_targets(sizes)
    assert got == {s: pytest.approx(t, rel=1e-9) for s, t in expected.items()}


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_permutation(spark, size):
    df = spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size).cast("long"), F.lit(3)).alias("p"))
    places = [r.p for r in df.collect()]
    assert sorted(places) == list(range(size))
    assert size < 1000 or places != list(range(size))


def test_odd_rows_and_mixed_documents(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, long, "a", "en", 1), (1, long, "a", "en", 1), (None, "x y", "a", None, 2), (3, None, None, None, None), (4, "", "b", "en", 0), (5, long + " z", "b", "en", 9), (6, "q " * 900, "c", None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    got = mixing.shares(df).collect()
    assert len(got) == 7 and all(r.taken <= 2 * r.size for r in got)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    words = {}
    for r in out.collect():
        assert r.n_chars == len(r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    taken = {}
    for r in got:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    assert all(abs(words.get(i, 0) - t) <= 1 for i, t in taken.items())
    assert mixing.shares(df.limit(0)).collect() == [] and mixing.mixed(df.limit(0)).collect() == []


def test_documents_taken_in_part_give_the_words_of_the_drawn_blocks(spark):
    size, spaces = 20_000, [" ", "\n", "  ", "\n\n", "\t"]
    text = "".join(f"w{i}{spaces[i % 5]}" for i in range(size)).strip()
    # the long document is taken 1.3 times, the others twice
    rows = [(1, text, "c"), (2, "x\ny " * 2000, "a"), (2, "x\ny " * 2000, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {}
    for r in mixing.shares(df).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    out = mixing.mixed(df).collect()
    part = [r.text for r in out if r.doc_id == 1 and r.text != text]
    assert len(part) == 1 and text in [r.text for r in out]
    taken[1] -= size
    assert 0.25 * size < taken[1] < 0.35 * size
    places = [int(w[1:]) for w in part[0].split()]
    assert len(places) == taken[1] and places == sorted(set(places))
    # each tenth of the text gives its share
    for tenth in range(10):
        n = sum(tenth * size // 10 <= p < (tenth + 1) * size // 10 for p in places)
        assert 0.2 < n / (taken[1] / 10) < 2.5
    between = {p: s for p, s in zip(places, re.split(r"w\d+", part[0])[1:])}
    assert all(between[p] == spaces[p % 5] for p in places[:-1])
    whole = [r.text for r in out if r.doc_id == 2]
    assert sum(len(t.split()) for t in whole) == taken[2] and all("\n" in t for t in whole)


def replayed(docs):
    """(doc_id, taken) and words per shard and source, slot by slot, in plain Python."""

    def h(*parts):
        seed = 42
        for part in parts:
            data = part.encode() if isinstance(part, str) else struct.pack("<q" if isinstance(part, Long) else "<i", part)
            seed = xxhash.xxh64_intdigest(data, seed)
        return seed - (1 << 64) if seed >> 63 else seed

    def permuted(index, size, place, turn):
        for r in range(1, mixing.ROUNDS + 1):
            other = (h("turn", mixing.SEED, r, place, Long(turn)) - index) % size
            if h("swap", mixing.SEED, r, place, Long(turn), Long(max(index, other))) & 1:
                index = other
        return index

    sizes, words = {}, {}
    for i, text, source in sorted(docs, key=lambda d: (d[2] or "", d[0])):
        n = len(brute.WORD.findall(text or ""))
        words.setdefault(source, []).extend([i] * n)
        sizes[source] = sizes.get(source, 0) + n
    names = sorted(sizes)
    targets = level_targets(sizes)
    slots = []
    for s in names:
        wanted, blocks = round(targets[s]), -(-sizes[s] // mixing.BLOCK)
        slots.append(wanted // sizes[s] * blocks + -(-(wanted % sizes[s]) // mixing.BLOCK))
    ends = [sum(slots[: k + 1]) for k in range(len(slots))]
    shards = -(-ends[-1] // mixing.SHARD)
    filled, order = [0] * len(names), []
    for slot in range(ends[-1]):
        drawn = h("draw", mixing.SEED, Long(slot)) % ends[-1]
        place = next(k for k, e in enumerate(ends) if drawn < e)
        if filled[place] < slots[place]:
            order.append((slot // mixing.SHARD, place, filled[place]))
            filled[place] += 1
    order += [(shards, k, j) for k in range(len(names)) for j in range(filled[k], slots[k])]
    taken, held = {i: 0 for i, _, _ in docs}, {}
    for shard, place, j in order:
        s = names[place]
        blocks = -(-sizes[s] // mixing.BLOCK)
        turn, within = divmod(j, blocks)
        n = min(mixing.BLOCK, round(targets[s]) - turn * sizes[s] - within * mixing.BLOCK)
        at = permuted(within, blocks, place, turn) * mixing.BLOCK
        got = words[s][at : at + n]
        held[shard, s] = held.get((shard, s), 0) + len(got)
        for i in got:
            taken[i] += 1
    return taken, held


class Long(int):
    """A 64-bit number."""


def test_sequential_replay(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD", 16)
    docs = [(i, " ".join(["w"] * (i * 37 % 700 + (40_000 if i == 5 else 0))), "abc"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    taken, held = replayed(docs)
    assert {r.doc_id: r.taken for r in mixing.shares(df).collect()} == taken
    found = mixing.assembled(df).groupBy("shard", "source").agg(F.sum(F.col("stop") - F.col("first")).alias("n"))
    assert {(r.shard, r["source"]): r.n for r in found.collect()} == {k: n for k, n in held.items() if n}
    assert len({shard for shard, _ in held}) > 10


def test_many_equal_rows_and_clashing_columns(spark):
    names = ["doc", "mark", "_doc", "_places", "_copy", "_place", "place", "number", "row", "pass", "copy", "cut", "drawn", "size", "shard", "a.b"]
    text = "one two\nthree " * 100
    df = spark.range(4000).select(
        F.when(F.col("id") < 2000, 7).cast("long").alias("doc_id"),
        F.lit(text).alias("text"),
        F.lit("a").alias("source"),
        *[F.concat(F.lit(n), F.col("id") % 2).alias(n) for n in names],
    )
    none = df.limit(3).withColumn("text", F.lit(None).cast("string"))
    got = mixing.shares(df.union(none)).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("taken").alias("t")).collect()
    assert sum(r.n for r in got) == 4003 and sum(r.t for r in got) == 4000 * 300 * 1.5
    out = mixing.mixed(df)
    assert out.columns == df.columns
    for n in names:
        assert {r[0] for r in out.select(f"`{n}`").distinct().collect()} == {f"{n}0", f"{n}1"}
    assert out.agg(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0] == 4000 * 300 * 1.5
