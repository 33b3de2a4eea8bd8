"""Text helpers against Python's own rules."""

import random
from pathlib import PurePath

from pyspark.sql import functions as F

from docloom.functions import text
from docloom.functions.tokens import token_count

PIECES = ["a", "É", "ß", "9", "½", "_", "-", " ", "\t", "\n", "\x1c", "\x1f", "\x85", "\xa0", " ",
          "　", ".", ",", "!", "中", "😀", "́", "‿", "​"]


def _samples(n=400):
    rnd = random.Random(5)
    return ["", " ", "\xa0\t"] + ["".join(rnd.choices(PIECES, k=rnd.randint(1, 14))) for _ in range(n)]


def _apply(spark, column, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r.v for r in rows.select("i", column.alias("v")).orderBy("i").collect()]


def test_strip_and_word_count(spark):
    values = _samples()
    assert _apply(spark, text.strip("t"), values) == [v.strip() for v in values]
    assert _apply(spark, text.word_count(text.strip("t")), values) == [len(v.split()) for v in values]


def test_normalize_heading(spark):
    def expected(v):
        kept = "".join(c if c.isalnum() or c == "_" or c.isspace() else " " for c in v.lower())
        return " ".join(kept.split())

    values = _samples() + ["  **Table** of-Contents: ", "FLOW\tIndex"]
    assert _apply(spark, text.normalize_heading("t"), values) == [expected(v) for v in values]


def test_clean_title(spark):
    cases = {
        "A (very) long title: with many words, and more": "A_very_long_title_with_many_wo",
        "x" * 40: "x" * 30,
        "  Flow - chart_2!  ": "Flow_-_chart_2",
        "Été: ½ über": "Été_½_über",
        "a\tb/c.d": "abcd",
        "???": "",
        "": "",
    }
    assert _apply(spark, text.clean_title("t"), list(cases)) == list(cases.values())


def test_stem(spark):
    values = ["a.json", "a.b.txt", ".hidden", "plain", "x.tar.gz", "é.md", "a b.pdf"]
    assert _apply(spark, text.stem("t"), values) == [PurePath(v).stem for v in values]


def test_newlines_and_preview(spark):
    assert _apply(spark, text.unify_newlines("t"), ["a\r\nb\rc\n"]) == ["a\nb\nc\n"]
    assert _apply(spark, text.preview("t"), ["x" * 300, "ab"]) == ["x" * 200 + "...", "ab..."]


def test_token_count(spark):
    assert _apply(spark, token_count("t"), ["", "Hello, world!", "é_1 ½..", None]) == [0, 4, 4, 0]


def test_token_count_with_own_counter(spark):
    assert _apply(spark, token_count("t", F.length), ["abc", None]) == [3, 0]
