"""The splitter against a statement of its rules character by character."""

import random

from pyspark.sql import functions as F

from docloom.functions import splitting

RULES = [
    (200, 1, lambda t, i: t[i] in ".!?" and t[i + 1].isspace()),
    (200, 2, lambda t, i: t[i : i + 2] == "\n\n"),
    (100, 1, lambda t, i: t[i] == "\n"),
    (50, 1, lambda t, i: t[i].isspace()),
]


def plain_pieces(t, budget, overlap):
    if len(t) <= budget:
        return [t]
    out, start = [], 0
    while True:
        end = start + budget
        if end < len(t):
            limit = end
            for reach, kept, holds in RULES:
                hits = [i for i in range(max(start, limit - reach) + 1, limit) if holds(t, i)]
                if hits and hits[-1] + kept != limit:
                    end = hits[-1] + kept
                    break
        if t[start:end].strip():
            out.append(t[start:end].strip())
        if end >= len(t):
            return out
        start = max(start + 1, end - overlap)


def random_text(rnd, size):
    marks = ["a", "b", "é", "😀", " ", " ", ".", ". ", "! ", "\n", "\n\n", "\xa0", "\x1d", "word", "longerword"]
    weights = [rnd.random() ** 3 for _ in marks]
    text = ""
    while len(text) < size:
        text += rnd.choices(marks, weights)[0]
    return text[:size]


def test_random_texts(spark):
    rnd = random.Random(3)
    cases = []
    for i in range(300):
        cases.append((i, random_text(rnd, rnd.randint(0, 1500)), rnd.choice([100, 101, 150, 250, 600])))
    rows = spark.createDataFrame(cases, "i int, t string, b int")
    for overlap in (0, 20, 200):
        got = rows.select(
            "i", splitting.split_column(F.col("t"), F.col("b"), overlap).alias("p")
        ).collect()
        got = {r.i: r.p for r in got}
        for i, t, b in cases:
            assert got[i] == plain_pieces(t, b, overlap), (i, b, overlap)


def test_sentence_end_at_the_limit_is_no_hit():
    text = "one two. " + "x" * 40 + " y" + "z" * 30 + ". " + "tail " * 30
    limit = text.index(". tail") + 1
    assert text[limit - 1] == "."
    cut = splitting.cut_before(text, 0, limit)
    # neither that one nor the earlier sentence end: the last blank
    assert cut == text.index("yz")


def test_blank_line_across_the_limit_cuts_past_it():
    text = "x" * 99 + "\n\n" + "y" * 100
    assert splitting.cut_before(text, 0, 100) == 101


def test_hard_cut():
    assert splitting.pieces("x" * 250, 100, 10) == ["x" * 100, "x" * 100, "x" * 70]


def test_small_budget_crawls():
    assert len(splitting.pieces("y" * 400, 100, 200)) == 301


def test_empty_text_stays_one_piece(spark):
    row = spark.createDataFrame([("",)], "t string").select(
        splitting.split_column(F.col("t"), F.lit(100), 10).alias("p")
    )
    assert row.first().p == [""]


def test_blank_pieces_are_dropped():
    text = "a" * 60 + " " * 300 + "b" * 60
    assert splitting.pieces(text, 100, 0) == plain_pieces(text, 100, 0)
    assert all(p.strip() for p in splitting.pieces(text, 100, 0))
