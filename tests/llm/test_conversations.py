import random

import brute
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from docloom.llm import conversations

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
NONE = {c: 0 for c in COUNTS} | {"audit": "", "repaired_sha256": brute.sha(b"")}


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def expected(rows):
    convs = {r[0]: [] for r in rows}
    for r in brute.damaged(rows):
        convs[r[0]].append(r[1:])
    return {c: brute.repaired(x) if x else NONE for c, x in convs.items()}


def found(rows):
    rows = [r.asDict() for r in rows]
    out = {r["conv_id"]: {c: r[c] for c in COUNTS} for r in rows}
    assert len(out) == len(rows)
    return out


def random_rows(rng, convs, turns):
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system"] * 3 + ["tool", "", None, "s", "agent"]
    texts = ["Hello.", "Why?", "Yes!", "cut", "cut ", "so. \n", "", " \n\t", None, "Hello.\x85", "é", "ok.　", "1", "2.", "3.", "4.", "5."]
    rows = []
    for conv in convs:
        ids = [rng.choice([None, 0]) if rng.random() < 0.08 else i * rng.choice([1, 1, 1, 2]) for i in range(rng.choice(turns))]
        rows += [(conv, t, rng.choice(roles), rng.choice(texts)) for t in ids]
    return rows


def test_table(spark):
    df = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/conversations.parquet").repartition(5)
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    assert found(conversations.digests(df).collect()) == expected(rows)


def test_vectors_and_walks():
    rng = random.Random(3)
    for n in [*range(12), 50, 300]:
        codes = bytes(rng.choice([0, 1, 2, 3, 2, 3, 4, 6, 10, 11, 8]) for _ in range(n))
        v = conversations.END
        for c in reversed(codes):
            v = conversations._before(c, v)
        assert conversations.applied(conversations.matrix(codes), conversations.END) == v
        cut = rng.randrange(n + 1)
        middle = conversations.applied(conversations.matrix(codes[cut:]), conversations.END)
        edits, states = conversations.walks(codes, conversations.END, True)
        head, between = conversations.walks(codes[:cut], middle, False)
        tail, ends = conversations.walks(codes[cut:], conversations.END, True)
        assert edits == [h + tail[s] for h, s in zip(head, between)]
        assert states == [ends[s] for s in between]


@pytest.mark.parametrize("bits", [12, 2])
def test_random_conversations(spark, monkeypatch, bits):
    # of 4 rows each, segments end everywhere
    monkeypatch.setattr(conversations, "SEGMENT_BITS", bits)
    rows = random_rows(random.Random(bits), [*range(60), None], range(1, 14))
    rows += random_rows(random.Random(5), [1000], [700])
    assert found(conversations.digests(table(spark, rows).repartition(4)).collect()) == expected(rows)


def test_a_hot_conversation_of_equal_and_different_rows(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"text {i}.") for i in range(9000)]
    rows += [(2, None, "user", "again.")] * 9000 + [(3, 1, "user", "Hi."), (3, 2, "assistant", "Yes.")]
    got = found(conversations.digests(table(spark, rows)).collect())
    assert got == expected(rows)
    repair = conversations.Repair(table(spark, rows))
    assert repair.walks.where("conv = '=1'").count() >= 3
    lines = repair.lines().where("conv = '=1'").orderBy("line").collect()
    assert [(r.line, r.edit, r.role, r.text) for r in lines] == [(i, "K", rows[i][2], rows[i][3]) for i in range(9000)]


def test_odd_rows(spark):
    long = "word " * 300_000 + "end."
    rows = [(1, 1, "user", long), (1, 2, "assistant", " " * 500_000 + "x"), (None, None, None, None), (4, 7, None, ""), (5, 1, "system", "s."), (6, -3, "assistant", "a."), (6, 3, "assistant", "a?")]
    df = table(spark, rows).select("*", F.lit(1).alias("conv"), F.lit("x").alias("code"), F.lit(None).alias("place"))
    got = found(conversations.digests(df).collect())
    assert got == expected(rows)
    assert got[None]["blank"] == 1 and got[None]["audit"] == "D"
    assert conversations.digests(df.limit(0)).collect() == []
    # a conversation that loses all its rows
    gone = next(i for i in range(1000) if not brute.damaged([(i, 0, "user", "x.")]))
    assert found(conversations.digests(table(spark, [(gone, 0, "user", "x.")])).collect()) == {gone: NONE}
