"""Pages, tokens, packing, conversion and reassembly."""

import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.tokens import PythonCounter, token_count
from docloom.operators import documents
from docloom.schemas import DOC, PAGE, REJECT


def test_concat_pages(spark):
    pages = spark.createDataFrame(
        [("d", 2, "two"), ("d", 0, "zero"), ("d", 1, ""), ("e", 0, ""), ("e", 1, None), ("d", 10, "ten")],
        PAGE,
    )
    got = {r.source_file: (r.text, r.n_chars) for r in documents.concat_pages(pages).collect()}
    assert got == {"d": ("zero two ten", 12), "e": ("", 0)}


def test_token_report(spark):
    docs = spark.createDataFrame([("a.txt", "x y"), ("b.txt", "z."), ("c.txt", None)], DOC)
    rows = documents.token_report(docs).collect()
    per_file = {r.source_file: r.n_tokens for r in rows if not r.is_total}
    assert per_file == {"a.txt": 2, "b.txt": 2, "c.txt": 0}
    assert [(r.n_chars, r.n_tokens) for r in rows if r.is_total] == [(5, 4)]
    unread = spark.createDataFrame([("bad.txt", "not UTF-8")], REJECT)
    listed = documents.token_report(docs, rejects=unread).where("not is_total").collect()
    assert {r.source_file: r.n_tokens for r in listed} == {**per_file, "bad.txt": 0}


def test_pandas_counter(spark):
    @F.pandas_udf(T.LongType())
    def letters(texts: pd.Series) -> pd.Series:
        return texts.str.count("[a-z]")

    docs = spark.createDataFrame([("a.txt", "x y"), ("b.txt", "123")], DOC)
    got = {r.source_file: r.n_tokens for r in documents.token_counts(docs, letters).collect()}
    assert got == {"a.txt": 2, "b.txt": 0}


def count(text):
    return len(re.findall(r"[^\W_]|_", re.sub(r"\w+", "w", text))) + len(re.findall(r"[^\w\s]", text))


def plain_segments(text, limit, count=count):
    """Packing on whole texts, each candidate counted anew."""
    out, held = [], ""

    def offer(part, separator, when_too_large):
        nonlocal held
        joined = held + separator + part if held else part
        if count(joined) <= limit:
            held = joined
        elif held:
            out.append(held.strip())
            held = part
        else:
            when_too_large(part)

    def split_up(paragraph):
        for sentence in paragraph.split(". "):
            offer(sentence, ". ", lambda s: out.append(s.strip()))

    for paragraph in text.split("\n\n"):
        offer(paragraph, "\n\n", split_up)
    return out + [held.strip()] if held else out


def random_text(rnd):
    bits = ["word", "w", "é", ". ", ".", " ", " ", "\n", "\n\n", "\n\n", "!", "\t", "  "]
    weights = [rnd.random() for _ in bits]
    return "".join(rnd.choices(bits, weights, k=rnd.randint(0, 80)))


@pytest.mark.parametrize("limit", [1, 3, 8, 30])
def test_packing_random(spark, limit):
    rnd = random.Random(limit)
    texts = [random_text(rnd) for _ in range(300)] + ["", "\n\n", ". ", "a. b. c", "\n\n\n\nx"]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], DOC)
    got = {}
    for r in documents.pack_segments(docs, limit).orderBy("seg_idx").collect():
        got.setdefault(int(r.source_file), []).append(r.text)
    for i, text in enumerate(texts):
        assert got.get(i, []) == plain_segments(text, limit), repr(text)


def test_default_count_adds_up(spark):
    """The sum over parts and separators equals the count of the joined text."""
    rnd = random.Random(2)
    rows = [(random_text(rnd),) for _ in range(200)]
    got = spark.createDataFrame(rows, "t string").select("t", token_count("t").alias("n")).collect()
    assert [r.n for r in got] == [count(r.t) for r in got]


def test_oversized_paragraphs(spark):
    """Only while nothing is held, a large paragraph is cut into sentences."""
    large = "one two three. four five six"
    docs = spark.createDataFrame([("first", f"{large}\n\nx"), ("later", f"x\n\n{large}")], DOC)
    got = {}
    for r in documents.pack_segments(docs, 4).orderBy("seg_idx").collect():
        got.setdefault(r.source_file, []).append(r.text)
    assert got == {
        "first": ["one two three", "four five six\n\nx"],
        "later": ["x", large],
    }


def test_own_counter(spark):
    docs = spark.createDataFrame([("a", "aa\n\nbb\n\ncc")], DOC)
    rows = documents.pack_segments(docs, 6, F.length).orderBy("seg_idx").collect()
    assert [r.text for r in rows] == ["aa\n\nbb", "cc"]
    silent = documents.pack_segments(docs, 1, lambda c: F.lit(None).cast("int"))
    assert [r.text for r in silent.collect()] == ["aa\n\nbb\n\ncc"]  # a failing counter counts 0


@pytest.mark.parametrize("limit", [3, 8])
def test_python_counter_packs_alike(spark, limit):
    rnd = random.Random(limit)
    docs = spark.createDataFrame([(str(i), random_text(rnd)) for i in range(120)], DOC)

    def rows(counter):
        return sorted(map(tuple, documents.pack_segments(docs, limit, counter).collect()))

    assert rows(PythonCounter(count)) == rows(None)


@pytest.mark.parametrize("limit", [1, 2, 6])
def test_counts_that_do_not_add_up(spark, limit):
    """Four characters a token: parts of under four count nothing by themselves."""
    rnd = random.Random(limit)
    texts = ["a b\n\n" * 20, *[random_text(rnd) for _ in range(150)]]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], DOC)
    quarter = PythonCounter(lambda t: len(t) // 4)
    for counter in (quarter, lambda c: F.floor(F.length(c) / 4)):
        got = {}
        for r in documents.pack_segments(docs, limit, counter).orderBy("seg_idx").collect():
            got.setdefault(int(r.source_file), []).append(r.text)
        for i, text in enumerate(texts):
            assert got.get(i, []) == plain_segments(text, limit, lambda t: len(t) // 4), repr(text)


@pytest.mark.parametrize("limit", [0, 1, 2, 6, 40])
def test_monotone_counter_packs_alike(spark, limit):
    rnd = random.Random(limit)
    texts = ["a b\n\n" * 20, "\n\nx\n\n\n\ny", *[random_text(rnd) for _ in range(200)]]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], DOC)
    got = {}
    counter = PythonCounter(lambda t: len(t) // 4, monotone=True)
    for r in documents.pack_segments(docs, limit, counter).orderBy("seg_idx").collect():
        got.setdefault(int(r.source_file), []).append(r.text)
    for i, text in enumerate(texts):
        assert got.get(i, []) == plain_segments(text, limit, lambda t: len(t) // 4), repr(text)


def test_monotone_counter_is_called_a_few_times_a_segment(spark):
    for size, parts in ((40, 20_000), (1000, 3000), (3, 500)):
        calls = spark.sparkContext.accumulator(0)

        def words(text):
            calls.add(1)
            return len(text.split())

        docs = spark.createDataFrame([("a", "\n\n".join(["w"] * parts))], DOC)
        rows = documents.pack_segments(docs, size, PythonCounter(words, monotone=True)).collect()
        assert [len(r.text.split()) for r in rows] == [size] * (parts // size) + [parts % size] * (parts % size > 0)
        # counted twice if the plan runs twice; each count joins at most twice the segment
        assert calls.value <= len(rows) * (2 * size.bit_length() + 3)


def test_failing_counter_counts_nothing(spark):
    def fail(text):
        raise RuntimeError("no service")

    docs = spark.createDataFrame([("a", "aa\n\nbb")], DOC)
    assert documents.token_counts(docs, PythonCounter(fail)).first().n_tokens == 0
    assert documents.pack_segments(docs, 1, PythonCounter(fail)).first().text == "aa\n\nbb"


def test_conversion_and_reassembly(spark):
    docs = spark.createDataFrame([("a.txt", "aa\n\nbb\n\ncc"), ("empty.txt", ""), ("bad.txt", "y" * 150)], DOC)

    def shout(text):
        if text.startswith("y"):
            raise ValueError("no")
        return text.upper()

    segments = documents.pack_segments(docs, 1)
    converted = documents.transform_segments(segments, documents.converter(shout)).cache()
    got = {r.source_file: r.md for r in documents.assemble_markdown(converted, docs).collect()}
    assert got == {
        "a.md": "AA\n\n---\n\nBB\n\n---\n\nCC",
        "empty.md": "",
        "bad.md": "Error converting chunk: " + "y" * 100 + "...",
    }
    rate = documents.success_rate(converted).first()
    assert (rate.successful, rate.fully_converted, rate.files) == (2, 1, 2)
    unread = spark.createDataFrame([("worse.txt", "not UTF-8")], REJECT)
    assert tuple(documents.success_rate(converted, docs, unread).first()) == (3, 2, 4)
    converted.unpersist()


def test_nothing_to_convert(spark):
    empty = spark.createDataFrame([], DOC)
    converted = documents.transform_segments(documents.pack_segments(empty))
    assert documents.assemble_markdown(converted, empty).count() == 0
    assert tuple(documents.success_rate(converted).first()) == (0, 0, 0)
