"""Pages -> documents -> token-bounded segments -> markdown documents."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions import text
from docloom.functions.tokens import (
    Counter,
    PythonCounter,
    count_lists,
    count_parts,
    token_count,
)
from docloom.operators import calls

# Fixed values.
PAGE_SEPARATOR = " "
PARAGRAPH_SEPARATOR = "\n\n"
SENTENCE_SEPARATOR = ". "
SEGMENT_SEPARATOR = "\n\n---\n\n"
MAX_TOKENS = 30000
CONVERSION_ERROR = "Error converting chunk: "
CONVERSION_ERROR_PREVIEW = 100


def concat_pages(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, text) -> (source_file, text, n_chars).

    Empty pages leave no separator; a document of empty pages only yields "".
    The filter sits in the aggregate, so such a document keeps its row. A
    document is one row of the result and so within Spark's 2 GB per value.
    """
    joined = F.expr(
        f"listagg(text, '{PAGE_SEPARATOR}') within group (order by page_no) filter (where text <> '')"
    )
    docs = pages.groupBy(F.col("doc_id").alias("source_file")).agg(
        F.coalesce(joined, F.lit("")).alias("text")
    )
    return docs.withColumn("n_chars", F.length("text"))


def token_counts(docs: DataFrame, counter: Counter | None = None) -> DataFrame:
    return docs.select(
        "source_file",
        F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"),
        token_count("text", counter).alias("n_tokens"),
    )


def token_report(
    docs: DataFrame, counter: Counter | None = None, rejects: DataFrame | None = None
) -> DataFrame:
    """Tokens per file, and in the row with ``is_total`` over all files.

    Files that could not be read (``rejects``) are listed with 0.
    """
    counted = token_counts(docs, counter)
    if rejects is not None:
        counted = counted.unionByName(
            rejects.selectExpr("source_file", "0 as n_chars", "0L as n_tokens")
        )
    return (
        counted.rollup("source_file")
        .agg(
            F.sum(F.col("n_chars").cast("bigint")).alias("n_chars"),
            F.sum("n_tokens").alias("n_tokens"),
            (F.grouping("source_file") == 1).alias("is_total"),
        )
        .withColumn("source_file", F.when(~F.col("is_total"), F.col("source_file")))
    )


def _no_texts() -> Column:
    return F.array().cast("array<string>")


def _state(done: Column, open_: Column, tokens: Column) -> Column:
    return F.struct(done.alias("done"), open_.alias("open"), tokens.alias("tokens"))


def _packed(
    items: Column,
    done: Column,
    separator: str,
    counter: Counter | None,
    max_tokens: int,
    oversized: Callable[[Column, Column], Column],
    finish: Callable[[Column], Column],
) -> Column:
    """Greedy fold over the parts of a text (part, tokens, ...).

    The state holds the finished segments, the parts of the open segment and its
    tokens. Leading empty parts never open a segment. ``oversized`` gives the
    state after a too large part that meets no open segment. The default count adds up,
    so the parts are joined once, when their segment closes; another counter gets the
    joined text of every segment that is tried.
    """
    joint = token_count(F.lit(separator))

    def opened(done: Column, item: Column) -> Column:
        part = item["part"]
        open_ = F.when(part == "", _no_texts()).otherwise(F.array(part))
        return _state(done, open_, item["tokens"])

    def step(acc: Column, item: Column) -> Column:
        extended = F.concat(acc["open"], F.array(item["part"]))
        if counter is None:
            longer = acc["tokens"] + joint + item["tokens"]
        else:
            longer = token_count(F.array_join(extended, separator), counter)
        none_open = F.size(acc["open"]) == 0
        closed = F.concat(acc["done"], F.array(text.strip(F.array_join(acc["open"], separator))))
        return (
            F.when(none_open & (item["tokens"] <= max_tokens), opened(acc["done"], item))
            .when(none_open, oversized(acc["done"], item))
            .when(longer <= max_tokens, _state(acc["done"], extended, longer))
            .otherwise(opened(closed, item))
        )

    return F.aggregate(items, _state(done, _no_texts(), F.lit(0).cast("bigint")), step, finish)


def _longest_fit(held: str, parts: list[str], begin: int, separator: str, fits: Callable[[str], bool]) -> int:
    """How many parts from ``begin`` on a segment can take in, by a monotone counter.

    Steps are doubled until a count is too large, then halved; only the texts that are
    counted are joined.
    """

    def taken(n: int) -> bool:
        return fits(separator.join((held, *parts[begin : begin + n])))

    low, step = 0, 1
    most = len(parts) - begin
    while low < most and taken(min(most, low + step)):
        low = min(most, low + step)
        step *= 2
    high = min(most, low + step) if low < most else most + 1  # the first that is known not to fit
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if taken(middle) else (low, middle)
    return low


def _python_segments(counter: PythonCounter, max_tokens: int) -> Callable[[Column], Column]:
    """The fold for a counter that only Python can run: one call a part, or a few calls a
    segment if the counter is monotone."""

    def fits(part: str) -> bool:
        return counter.of_text(part) <= max_tokens

    def pack(whole: str) -> list[str]:
        done: list[str] = []
        held = ""

        def fold(parts: list[str], separator: str, oversized: Callable[[str], None]) -> None:
            nonlocal held
            at = 0
            while at < len(parts):
                if held and counter.monotone:
                    more = _longest_fit(held, parts, at, separator, fits)
                    held = separator.join((held, *parts[at : at + more]))
                    at += more
                    if at < len(parts):
                        done.append(held.strip())
                        held = parts[at]
                        at += 1
                    continue
                part = parts[at]
                at += 1
                longer = separator.join((held, part)) if held else part
                if fits(longer):
                    held = longer
                    continue
                if not held:
                    oversized(part)
                    continue
                done.append(held.strip())
                held = part

        def into_sentences(paragraph: str) -> None:
            fold(paragraph.split(SENTENCE_SEPARATOR), SENTENCE_SEPARATOR, lambda s: done.append(s.strip()))

        fold(whole.split(PARAGRAPH_SEPARATOR), PARAGRAPH_SEPARATOR, into_sentences)
        return [*done, held.strip()] if held else done

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else pack(t) for t in texts], index=texts.index, dtype=object)

    return run


def pack_segments(
    docs: DataFrame, max_tokens: int = MAX_TOKENS, counter: Counter | None = None
) -> DataFrame:
    """(source_file, text) -> (source_file, seg_idx, text), segments of whole paragraphs.

    A paragraph that is too large is cut into sentences only while no segment is
    open; otherwise it becomes a segment of its own. The tokens of a segment are those
    of its joined text, whatever the counter. Runs inside each document's row, without
    any exchange.
    """
    if isinstance(counter, PythonCounter):
        segments = _python_segments(counter, max_tokens)(F.col("text"))
        return docs.select("source_file", F.posexplode(segments).alias("seg_idx", "text"))
    parts = docs.select("source_file", F.split("text", PARAGRAPH_SEPARATOR, -1).alias("part"))
    counted = parts.withColumn("tokens", count_parts(F.col("part"), counter))
    # only a paragraph that is too large is taken apart
    cut = counted.withColumn(
        "sentence",
        F.transform(
            F.arrays_zip("part", "tokens"),
            lambda p: F.when(p["tokens"] > max_tokens, F.split(p["part"], r"\. ", -1)).otherwise(_no_texts()),
        ),
    ).withColumn("sentence_tokens", count_lists(F.col("sentence"), counter))

    def sentence_alone(done: Column, sentence: Column) -> Column:
        closed = F.concat(done, F.array(text.strip(sentence["part"])))
        return _state(closed, _no_texts(), F.lit(0).cast("bigint"))

    def as_one_part(acc: Column) -> Column:
        rest = F.array(F.array_join(acc["open"], SENTENCE_SEPARATOR))
        open_ = F.when(F.size(acc["open"]) == 0, acc["open"]).otherwise(rest)
        return _state(acc["done"], open_, acc["tokens"])

    def into_sentences(done: Column, paragraph: Column) -> Column:
        sentences = F.zip_with(
            paragraph["sentence"],
            paragraph["sentence_tokens"],
            lambda s, n: F.struct(s.alias("part"), n.alias("tokens")),
        )
        return _packed(
            sentences,
            done,
            SENTENCE_SEPARATOR,
            counter,
            max_tokens,
            sentence_alone,
            as_one_part,
        )

    def close_last(acc: Column) -> Column:
        last = F.array(text.strip(F.array_join(acc["open"], PARAGRAPH_SEPARATOR)))
        return F.concat(acc["done"], F.when(F.size(acc["open"]) == 0, _no_texts()).otherwise(last))

    segments = _packed(
        F.arrays_zip("part", "tokens", "sentence", "sentence_tokens"),
        _no_texts(),
        PARAGRAPH_SEPARATOR,
        counter,
        max_tokens,
        into_sentences,
        close_last,
    )
    return cut.select("source_file", F.posexplode(segments).alias("seg_idx", "text"))


Converter = Callable[[Column], Column]
CONVERTED = T.StructType(
    [T.StructField("md", T.StringType()), T.StructField("ok", T.BooleanType())]
)


def converter(convert: Callable[[str], str], retry: calls.Retry = calls.Retry()) -> Converter:
    """Wrap a function of one text as a segment converter.

    A segment whose conversion raises, as often as ``retry`` says, becomes a sentence with
    the start of its text, and ``ok`` is false.
    """

    @F.pandas_udf(CONVERTED)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for segment in texts:
            try:
                rows.append((retry(partial(convert, segment)), True))
            except Exception:
                rows.append((f"{CONVERSION_ERROR}{segment[:CONVERSION_ERROR_PREVIEW]}...", False))
        return pd.DataFrame(rows, columns=["md", "ok"])

    return run


def transform_segments(segments: DataFrame, convert: Converter | None = None) -> DataFrame:
    """(source_file, seg_idx, text) -> (source_file, seg_idx, md, ok); default: as is."""
    if convert is None:
        return segments.select(
            "source_file", "seg_idx", F.col("text").alias("md"), F.lit(True).alias("ok")
        )
    converted = segments.select("source_file", "seg_idx", convert(F.col("text")).alias("result"))
    return converted.select("source_file", "seg_idx", "result.md", "result.ok")


def transform_remembered(
    segments: DataFrame,
    convert: Callable[[str], str],
    memory: calls.Memory,
    retry: calls.Retry = calls.Retry(),
) -> DataFrame:
    """``transform_segments`` with a function of one text that is called once for each
    different segment, and not again for one that ``memory`` holds."""

    def call(texts: list[str]) -> list[str]:
        return [convert(text) for text in texts]

    # what a failed conversion shows is taken first, so that whole texts don't move to the results
    preview = F.substring("text", 1, CONVERSION_ERROR_PREVIEW).alias("preview")
    rows = segments.select("source_file", "seg_idx", "text", preview)
    found = calls.remembered(rows, "text", call, T.StringType(), memory, retry=retry)
    failed = F.concat(F.lit(CONVERSION_ERROR), "preview", F.lit("..."))
    return found.select(
        "source_file", "seg_idx", F.coalesce("result", failed).alias("md"), F.col("result").isNotNull().alias("ok")
    )


def assemble_markdown(converted: DataFrame, docs: DataFrame) -> DataFrame:
    """Segments back into one markdown text per document; none for it yields ""."""
    joined = F.expr(f"listagg(md, '{SEGMENT_SEPARATOR}') within group (order by seg_idx)")
    texts = converted.groupBy("source_file").agg(joined.alias("md"))
    return (
        docs.select("source_file")
        .join(texts, "source_file", "left")
        .select(
            F.concat(text.stem("source_file"), F.lit(".md")).alias("source_file"),
            F.coalesce("md", F.lit("")).alias("md"),
        )
    )


def success_rate(
    converted: DataFrame, docs: DataFrame | None = None, rejects: DataFrame | None = None
) -> DataFrame:
    """How many files came through, and how many of them with every segment converted.

    A failed conversion leaves its error in the text and does not fail its file; only
    files that could not be read do. ``docs`` brings in files without segments,
    ``rejects`` those not read at all.
    """
    files = converted.groupBy("source_file").agg(F.bool_and("ok").alias("ok"))
    if docs is not None:
        files = (
            docs.select("source_file")
            .join(files, "source_file", "left")
            .withColumn("ok", F.coalesce("ok", F.lit(True)))
        )
    files = files.withColumn("read", F.lit(True))
    if rejects is not None:
        files = files.unionByName(rejects.selectExpr("source_file", "false as ok", "false as read"))
    return files.agg(
        F.count_if("read").alias("successful"),
        F.count_if("ok").alias("fully_converted"),
        F.count(F.lit(1)).alias("files"),
    )
