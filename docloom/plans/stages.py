"""Compositions of operators, with tables written where several reads follow."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame

from docloom.functions.splitting import BOUNDARIES
from docloom.functions.tokens import Counter
from docloom.operators import calls, chunking, documents, outline
from docloom.shared import write_buckets, write_stage


def texts_to_markdown(
    docs: DataFrame,
    max_tokens: int = documents.MAX_TOKENS,
    convert: documents.Converter | Callable[[str], str] | None = None,
    counter: Counter | None = None,
    memory: calls.Memory | None = None,
    retry: calls.Retry = calls.Retry(),
) -> DataFrame:
    """(source_file, text) -> (source_file, md). A costly converter runs once: its result is staged.

    With a ``memory``, ``convert`` is a function of one text, and a segment that was converted
    before, in a run that failed for instance, is not converted again. Results are then read
    from there and not staged as well.
    """
    segments = documents.pack_segments(docs, max_tokens, counter)
    if memory is not None:
        segments = write_stage(segments, "segments")
        converted = documents.transform_remembered(segments, convert, memory, retry)
    else:
        converted = documents.transform_segments(segments, convert)
        if convert is not None:
            converted = write_stage(converted, "converted")
    return documents.assemble_markdown(converted, docs)


def _warn_of_crawling(chunk_size: int, overlap: int, max_background: int | None) -> None:
    """A piece may end ``reach`` characters early; if it is then no longer than the
    overlap, the next one starts a single character later."""
    budget = chunking.smallest_budget(chunk_size, max_background)
    reach = max(reach for _, reach, _ in BOUNDARIES)
    if budget <= overlap + reach:
        warnings.warn(
            f"{budget} characters of content next to the largest background and an overlap"
            f" of {overlap}: long sections may fall into very many pieces",
            stacklevel=3,
        )


def entries_to_pieces(
    entries: DataFrame,
    chunk_size: int = chunking.CHUNK_SIZE,
    overlap: int = chunking.OVERLAP,
    max_background: int | None = None,
) -> DataFrame:
    """Entries from any source (a table) -> entries with background and pieces."""
    _warn_of_crawling(chunk_size, overlap, max_background)
    with_background = chunking.with_background(entries, chunk_size, max_background)
    return chunking.split_pieces(chunking.with_budget(with_background, chunk_size), overlap)


def markdown_to_pieces(
    md_docs: DataFrame,
    chunk_size: int = chunking.CHUNK_SIZE,
    overlap: int = chunking.OVERLAP,
    max_background: int | None = None,
) -> DataFrame:
    """Markdown documents -> entries with background and pieces.

    One exchange brings a file's sections together; nothing else moves.
    """
    _warn_of_crawling(chunk_size, overlap, max_background)
    sections = outline.markdown_to_sections(md_docs)
    entries = chunking.entries_with_background(sections, chunk_size, max_background)
    return chunking.split_pieces(chunking.with_budget(entries, chunk_size), overlap)


def number_chunks(pieces: DataFrame, earlier: int = 0) -> DataFrame:
    """Entries with pieces -> chunks with ids, numbered after ``earlier`` chunks.

    What chunks are made of is staged by file, since the numbering first reads the counts.
    """
    needed = pieces.select("source_file", "entry_pos", "metadata", "background", "pieces")
    staged = write_buckets(needed, "pieces", "source_file", "entry_pos")
    return chunking.build_chunks(chunking.number_entries(staged, earlier))


def entries_to_chunks(
    entries: DataFrame,
    chunk_size: int = chunking.CHUNK_SIZE,
    overlap: int = chunking.OVERLAP,
    max_background: int | None = None,
) -> DataFrame:
    return number_chunks(entries_to_pieces(entries, chunk_size, overlap, max_background))


def markdown_to_chunks(
    md_docs: DataFrame,
    chunk_size: int = chunking.CHUNK_SIZE,
    overlap: int = chunking.OVERLAP,
    max_background: int | None = None,
    earlier: int = 0,
) -> DataFrame:
    return number_chunks(markdown_to_pieces(md_docs, chunk_size, overlap, max_background), earlier)
