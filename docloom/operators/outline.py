"""Markdown documents -> headings -> sections -> entries with their ancestors.

Everything runs on one partitioning by ``source_file``: the parse happens inside
a document's row, and the two sets of running windows share partitioning and
order. If the documents were assembled by ``source_file`` just before, there is
no exchange at all. A window group is one document, which was one row already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions import boilerplate, fuzzy, text
from docloom.shared import write_stage

# Fixed values.
LEVELS = range(1, 7)
MIN_CONTENT = 20  # a section body must be longer than this
PATH_SEPARATOR = " > "

# Keywords up to this size are one index, which takes some hundred times that room.
KEYWORD_BYTES = 1 << 20

# A heading: one to six hashes, blanks or line breaks, then the rest of a line.
HEADING = rf"(?mdU)^#{{1,6}}{text.SPACE}+.+$"


def parse_headings(md_docs: DataFrame) -> DataFrame:
    """(source_file, md) -> (source_file, pos, level, title, body), in document order.

    The same pattern finds the headings and cuts the text between them, so both
    arrays line up; text before the first heading is dropped. The body starts
    after the first line break behind the heading's first character, which for a
    title on a later line than its hashes puts the title into the body.
    """
    pattern = f"r'{HEADING}'"
    parsed = md_docs.selectExpr(
        "source_file",
        f"""posexplode(arrays_zip(
            regexp_extract_all(md, {pattern}, 0),
            slice(split(md, {pattern}, -1), 2, size(split(md, {pattern}, -1))))) as (pos, part)""",
    )
    headings = parsed.selectExpr(
        "source_file", "pos", "part['0'] as head", "concat(part['0'], part['1']) as block"
    ).selectExpr(
        "source_file", "pos", "head", "block", "length(head) - length(ltrim('#', head)) as level"
    )
    titled = headings.select(
        "source_file", "pos", "level", "block", text.strip(F.expr("substr(head, level + 1)")).alias("title")
    )
    # Without any line break the body is cut from inside the heading line.
    body = F.expr(
        """substr(block, case when instr(block, '\n') > 0 then instr(block, '\n') + 1
                              else length(title) + 1 end)"""
    )
    return titled.select("source_file", "pos", "level", "title", text.strip(body).alias("body"))


def flag_boilerplate(
    headings: DataFrame, keywords: DataFrame | None = None, table_bytes: int = KEYWORD_BYTES
) -> DataFrame:
    """Add ``is_toc``. Row-local: no join on titles, so a frequent title costs no skew.

    ``keywords`` has a column ``keyword`` of texts written as normalized headings are; by
    default they are the built-in ones. They travel to the tasks as one index while they are
    no larger than ``table_bytes``. A larger table goes in blocks of that size over the
    distinct titles, each block over those that no block before has flagged.
    """
    normalized = text.normalize_heading("title")
    titled = headings.withColumn("normalized", normalized)
    if keywords is None:
        verdict = boilerplate.is_boilerplate(F.col("normalized"))
        return titled.select(*headings.columns, verdict.alias("is_toc"))
    given = write_stage(keywords.select("keyword").where("keyword <> ''").distinct(), "keywords")
    size = given.agg(F.sum(F.octet_length("keyword"))).first()[0] or 0
    if size <= table_bytes:
        verdict = _fuzzy(given)(F.col("normalized"), boilerplate.is_technical(F.col("normalized")))
        return titled.select(*headings.columns, F.coalesce(verdict, F.lit(False)).alias("is_toc"))
    blocks = 2 * -(-size // table_bytes)
    block = F.pmod(F.xxhash64("keyword"), F.lit(blocks))
    open_ = write_stage(titled.select("normalized").where("normalized is not null").distinct(), "titles")
    flagged = []
    for b in range(blocks):
        verdict = _fuzzy(given.where(block == b))
        passed = verdict(F.col("normalized"), boilerplate.is_technical(F.col("normalized")))
        seen = write_stage(open_.withColumn("is_toc", passed), "titles")
        flagged.append(seen.where("is_toc"))
        open_ = seen.where("not is_toc").drop("is_toc")
    hits = reduce(DataFrame.union, flagged)
    return titled.join(hits, "normalized", "left").select(
        *headings.columns, F.coalesce("is_toc", F.lit(False)).alias("is_toc")
    )


def _fuzzy(keywords: DataFrame) -> Callable[[Column, Column], Column]:
    """Whether a title passes with any of these keywords, which the driver reads."""
    shared = keywords.sparkSession.sparkContext.broadcast([r.keyword for r in keywords.collect()])

    @F.pandas_udf(T.BooleanType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        index = fuzzy.KeywordIndex(shared.value)
        for titles, technical in batches:
            known = titles.notna()
            found = fuzzy.verdicts(index, zip(titles[known], technical[known]))
            out = pd.Series([None] * len(titles), index=titles.index, dtype="object")
            out[known] = found
            yield out

    return run


def _in_document(until: str) -> str:
    return f"over (partition by source_file order by pos rows between unbounded preceding and {until})"


def flag_skipped(flagged: DataFrame) -> DataFrame:
    """Add ``skipped``: in the subtree of a boilerplate heading.

    That holds if, for some level l, the last heading so far at level l or above
    is a boilerplate heading of level l.
    """
    so_far = _in_document("current row")
    marked = flagged.selectExpr(
        "*",
        *[f"max(case when level = {n} then pos end) {so_far} as last_{n}" for n in LEVELS],
        *[f"max(case when level = {n} and is_toc then pos end) {so_far} as toc_{n}" for n in LEVELS],
    )
    # greatest() passes over nulls
    covered = [
        f"coalesce(toc_{n} = greatest({', '.join(f'last_{k}' for k in range(1, n + 1))}, -1), false)"
        for n in LEVELS
    ]
    return marked.selectExpr(*flagged.columns, f"{' or '.join(covered)} as skipped")


def skip_subtrees(flagged: DataFrame) -> DataFrame:
    kept = flag_skipped(flagged).where(~F.col("skipped"))
    return kept.drop("skipped")


def sections(kept: DataFrame) -> DataFrame:
    """Headings whose body is long enough; shorter ones take no part in the hierarchy."""
    return kept.where(F.length("body") > MIN_CONTENT).select(
        "source_file", "pos", "level", "title", F.col("body").alias("content")
    )


def ancestors(section_rows: DataFrame, *carried: str) -> DataFrame:
    """Add ``entry_pos`` and ``ancestors``: title and carried columns, from the top.

    Of the last sections before a row, one per level above the row's own, those
    are ancestors that no section of a higher level has followed.
    """
    before = _in_document("1 preceding")
    fields = ", ".join(["pos", "title", *carried])
    above = LEVELS[:-1]
    seen = section_rows.selectExpr(
        "*",
        "row_number() over (partition by source_file order by pos) - 1 as entry_pos",
        *[f"last(case when level = {n} then struct({fields}) end, true) {before} as up_{n}" for n in above],
    )

    def ancestor(n: int) -> str:
        holds = [f"level > {n}"] + [f"coalesce(up_{k}.pos < up_{n}.pos, true)" for k in range(1, n)]
        return f"case when {' and '.join(holds)} then up_{n} end"

    return seen.selectExpr(
        *section_rows.columns,
        "entry_pos",
        f"array_compact(array({', '.join(map(ancestor, above))})) as ancestors",
    )


def hierarchy(section_rows: DataFrame) -> DataFrame:
    """Add ``entry_pos`` and ``hierarchy``, the titles of the ancestors from the top."""
    return ancestors(section_rows).select(
        *section_rows.columns, "entry_pos", F.col("ancestors.title").alias("hierarchy")
    )


def entry_metadata() -> Column:
    return F.expr(
        f"""struct(
            title,
            hierarchy,
            array_join(array_append(hierarchy, title), '{PATH_SEPARATOR}') as full_path,
            level,
            length(content) as content_length,
            size(split(content, r'{text.BETWEEN_WORDS}')) as word_count) as metadata"""
    )


def entries(section_rows: DataFrame) -> DataFrame:
    """Sections -> entries (source_file, entry_pos, content, metadata)."""
    return hierarchy(section_rows).select("source_file", "entry_pos", "content", entry_metadata())


def markdown_to_sections(md_docs: DataFrame) -> DataFrame:
    return sections(skip_subtrees(flag_boilerplate(parse_headings(md_docs))))


def markdown_to_entries(md_docs: DataFrame) -> DataFrame:
    return entries(markdown_to_sections(md_docs))


def entry_summary(entry_rows: DataFrame) -> DataFrame:
    return entry_rows.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("entries"),
        F.sum("metadata.word_count").alias("total_words"),
        F.sum("metadata.content_length").alias("total_chars"),
        F.avg("metadata.word_count").alias("words_per_entry"),
    )
