"""The index of keywords against scoring every stretch of every pair."""

import random

import pytest
from pyspark.sql import functions as F

from docloom.functions import boilerplate, fuzzy
from docloom.operators import outline

SYLLABLES = ["con", "tent", "ta", "ble", "of", "in", "dex", "re", "fer", "ence", "ap", "pen", "dix", "a", "é", "list", "fig", "ure"]


def words(rnd, most=4):
    return " ".join("".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 3))) for _ in range(rnd.randint(1, most)))


def spoiled(rnd, text):
    letters = list(text)
    for _ in range(rnd.randint(0, 1 + len(text) // 6)):
        at = rnd.randrange(len(letters) + 1)
        if rnd.random() < 0.5:
            letters[at : at + 1] = []
        else:
            letters.insert(at, rnd.choice("aeinrst "))
    return "".join(letters)


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def best(a, b, score):
    """The larger of the score of both whole and that of the shorter with each stretch."""
    found = [score(a, b)]
    for s, t in ((a, b), (b, a)):
        if len(s) <= len(t):
            found += [score(s, t[max(o, 0) : o + len(s)]) for o in range(1 - len(s), len(t))]
    return max(found)


def plain(heading, technical, keywords, score=lambda a, b: 200 * common(a, b) / (len(a) + len(b))):
    if not heading:
        return bool(keywords)
    for k in keywords:
        limit = 85 if not technical else 90 if set(k.split()) <= set(heading.split()) else 97
        if best(heading, k, score) >= limit:
            return True
    return False


def test_against_every_stretch():
    rnd = random.Random(7)
    keywords = sorted({words(rnd) for _ in range(25)} | {"ab", "of", "aaaa"})
    headings = [words(rnd, 5) for _ in range(60)] + [spoiled(rnd, rnd.choice(keywords)) for _ in range(120)]
    headings += ["", "a", "z", "aa", "aaa", "aaaaaa", "xofx", "o f"]
    index, hits = fuzzy.KeywordIndex(keywords), 0
    for heading in headings:
        for technical in (False, True):
            wanted = plain(heading, technical, keywords)
            assert index.passes(heading, technical) == wanted, (heading, technical)
            hits += wanted
    assert 40 < hits < 300


def test_ten_thousand_keywords():
    rnd = random.Random(11)
    keywords = set()
    while len(keywords) < 10_000:
        keywords.add("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(4, 14))) + rnd.choice(["", " list", "s"]))
    keywords = sorted(keywords)
    patterns = {k: fuzzy.Pattern(k) for k in keywords}

    def score(a, b):  # bit vectors, with nothing left out
        first, second = (a, b) if a in patterns or b not in patterns else (b, a)
        return (patterns.get(first) or fuzzy.Pattern(first)).score(second)

    index, verdicts = fuzzy.KeywordIndex(keywords), []
    headings = [spoiled(rnd, rnd.choice(keywords)) for _ in range(6)] + ["".join(rnd.choices("aeiourstln ", k=14)) for _ in range(4)]
    for heading in headings:
        verdicts.append(index.passes(heading, False))
        assert verdicts[-1] == plain(heading, False, keywords, score), heading
    assert any(verdicts) and not all(verdicts)
    assert all(len(index.candidates(h)) < 2500 for h in headings)


def test_built_in_keywords_give_the_built_in_verdicts():
    rnd = random.Random(5)
    keywords = [k for k in boilerplate.FILTER_KEYWORDS if k]
    headings = sorted({spoiled(rnd, rnd.choice(keywords)) + rnd.choice(["", "", " x", " overview"]) for _ in range(400)} - {""})
    technical = [rnd.random() < 0.3 for _ in headings]
    index = fuzzy.KeywordIndex(keywords)
    got = [index.passes(h, t) for h, t in zip(headings, technical)]
    settled = [any(k in h or h in k for k in keywords) for h in headings]
    scored = boilerplate.passes(headings, technical)
    assert got == [bool(a or b) for a, b in zip(settled, scored)]


HEADINGS = "source_file string, pos int, title string"


@pytest.mark.parametrize("table_bytes", [1 << 20, 60])
def test_flagging_with_a_table(spark, table_bytes):
    rnd = random.Random(3)
    keywords = sorted({words(rnd, 2) for _ in range(20)})
    titles = [words(rnd) for _ in range(60)] + [spoiled(rnd, rnd.choice(keywords)) for _ in range(60)] + ["Re-ference", "", None, "  "] + ["INDEX"] * 100
    rows = spark.createDataFrame([("f", i, t) for i, t in enumerate(titles)], HEADINGS).repartition(3)
    given = spark.createDataFrame([(k, 1) for k in keywords * 2] + [("", 1), (None, 2)], "keyword string, title int")
    got = outline.flag_boilerplate(rows, given, table_bytes)
    assert got.columns == [*rows.columns, "is_toc"]
    from docloom.functions.text import normalize_heading

    shown = rows.select("pos", normalize_heading("title").alias("n"), boilerplate.is_technical(normalize_heading("title")).alias("t"))
    wanted = {r.pos: r.n is not None and plain(r.n, r.t, keywords) for r in shown.collect()}
    assert {r.pos: r.is_toc for r in got.collect()} == wanted
    assert len(set(wanted.values())) == 2
    none = outline.flag_boilerplate(rows, given.limit(0), table_bytes)
    assert none.where("is_toc").count() == 0 and none.count() == len(titles)
    if table_bytes > 60:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "hashpartitioning" not in plan
    assert outline.flag_boilerplate(rows.where(F.lit(False)), given, table_bytes).collect() == []
