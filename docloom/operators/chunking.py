"""Entries -> background, budget, pieces -> numbered chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import splitting, text
from docloom.operators import outline
from docloom.operators.numbering import running_start

# Fixed values.
CHUNK_SIZE = 5000
OVERLAP = 200
BACKGROUND_SHARE = 0.4
MIN_BUDGET = 100
OPEN_LABEL = "[BACKGROUND]\n"
CLOSE_LABEL = "\n[/BACKGROUND]"
TRUNCATED = "[TRUNCATED] "
SHRINK_TRUNCATED = 30  # taken off the room when a truncated background is cut again
SHRINK_WHOLE = 28  # the same for a background that was whole
PART_SEPARATOR = "\n\n"
UNKNOWN_TITLE = "Unknown"
CHUNK_ID = "chunk_%06d_%s_%s_%d"

# Entries of one file and path that a join key may hold.
SLICE_ENTRIES = 10_000


def background_limit(chunk_size: int = CHUNK_SIZE, max_background: int | None = None) -> int:
    """0 or None means the default share of the chunk size."""
    return max_background or int(chunk_size * BACKGROUND_SHARE)


def _labelled(inner: str) -> str:
    return f"concat('{OPEN_LABEL}', {inner}, '{CLOSE_LABEL}')"


def _background(raw: str, limit: int) -> str:
    """Joined ancestor contents -> a labelled text that shows the end; "" for none."""
    # a limit below the marker's length keeps nothing of the text
    end = f"substr({raw}, length({raw}) - {limit} + {len(TRUNCATED) + 1})"
    kept = f"case when length({raw}) > {limit} then concat('{TRUNCATED}', {end}) else {raw} end"
    return f"case when {raw} <> '' then {_labelled(kept)} else '' end"


def _ancestor_part(content: str, limit: int) -> Column:
    """As much of an ancestor as a background can show.

    One character more than the limit still tells that it was too long.
    """
    return text.tail(text.strip(content), F.lit(limit + 1))


def entries_with_background(
    sections: DataFrame, chunk_size: int = CHUNK_SIZE, max_background: int | None = None
) -> DataFrame:
    """Sections -> entries with ``background``, on the partitioning by file they have.

    An ancestor's title stands for the first section of the file that has it, which
    is never later than the ancestor. So running windows carry the contents along
    with the titles, and no join is needed.
    """
    limit = background_limit(chunk_size, max_background)
    shown = sections.withColumn("shown", _ancestor_part("content", limit)).selectExpr(
        "*", "first(shown) over (partition by source_file, title order by pos) as first_content"
    )
    rows = outline.ancestors(shown, "first_content").selectExpr(
        "*",
        "ancestors.title as hierarchy",
        f"array_join(ancestors.first_content, '{PART_SEPARATOR}') as raw",
    )
    return rows.select(
        "source_file",
        "entry_pos",
        "content",
        outline.entry_metadata(),
        F.expr(_background("raw", limit)).alias("background"),
    )


def with_background(
    entries: DataFrame, chunk_size: int = CHUNK_SIZE, max_background: int | None = None
) -> DataFrame:
    """Add ``background`` to entries from any source: the contents of the titles in
    their hierarchy. A title stands for the first entry of the file that has it; an
    unknown title is left out.

    The background depends only on (file, hierarchy), so it is built once per
    distinct path, not per entry; siblings share it. A path with very many entries
    is built once per slice of the file, so that no join key holds more than a
    slice. Only the part of an ancestor that can show moves.

    ``entries`` is read three times; hand in a table, not a long lineage.
    """
    limit = background_limit(chunk_size, max_background)
    path, slice_ = ["source_file", "hierarchy", "slice"], f"entry_pos div {SLICE_ENTRIES} as slice"
    first_by_title = entries.groupBy("source_file", F.col("metadata.title").alias("title")).agg(
        F.min_by(_ancestor_part("content", limit), "entry_pos").alias("ancestor")
    )
    paths = (
        entries.selectExpr("source_file", "metadata.hierarchy as hierarchy", slice_)
        .where("size(hierarchy) > 0")
        .distinct()
    )
    parts = paths.selectExpr(
        *path, "posexplode(hierarchy) as (depth, title)"
    ).join(first_by_title, ["source_file", "title"])
    joined = f"""array_join(
        transform(array_sort(collect_list(struct(depth, ancestor))), x -> x.ancestor), '{PART_SEPARATOR}')"""
    backgrounds = parts.groupBy(*path).agg(F.expr(joined).alias("raw")).selectExpr(
        *path, f"{_background('raw', limit)} as background"
    )
    keyed = entries.selectExpr("*", "metadata.hierarchy as hierarchy", slice_)
    return keyed.join(backgrounds, path, "left").selectExpr(
        *entries.columns, "coalesce(background, '') as background"
    )


def with_budget(with_bg: DataFrame, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """Shrink an oversized background and add ``budget``, the room for content.

    Below the minimum room the background is cut to its end once more and gets
    the marker, whether or not it was truncated before. If not even the marker
    fits, a truncated background stays as it is and a whole one goes.
    """
    room = chunk_size - MIN_BUDGET
    labels = len(OPEN_LABEL) + len(CLOSE_LABEL)
    inner = f"substr(background, {len(OPEN_LABEL) + 1}, length(background) - {labels})"

    def recut(body: str, size: int) -> str:
        return _labelled(f"concat('{TRUNCATED}', right({body}, {size}))")

    again, whole = room - SHRINK_TRUNCATED, room - SHRINK_WHOLE
    cut_again = recut(f"substr({inner}, {len(TRUNCATED) + 1})", again) if again > 0 else "background"
    cut_whole = recut(inner, whole) if whole > 0 else "''"
    shrunk = f"case when contains({inner}, '{TRUNCATED}') then {cut_again} else {cut_whole} end"
    too_large = f"background <> '' and {chunk_size} - length(background) < {MIN_BUDGET}"
    others = [c for c in with_bg.columns if c != "background"]
    return with_bg.selectExpr(
        *others,
        f"case when {too_large} then {shrunk if room > 0 else repr('')} else background end as background",
    ).selectExpr("*", f"greatest({chunk_size} - length(background), {MIN_BUDGET}) as budget")


def smallest_budget(chunk_size: int = CHUNK_SIZE, max_background: int | None = None) -> int:
    """The room for content next to the largest background."""
    largest = background_limit(chunk_size, max_background) + len(OPEN_LABEL) + len(CLOSE_LABEL)
    return max(MIN_BUDGET, chunk_size - largest)


def split_pieces(budgeted: DataFrame, overlap: int = OVERLAP) -> DataFrame:
    """Add ``pieces``, the array of content pieces of each entry.

    Where the budget is not well above the overlap, the cursor may advance by
    single characters and yield very many pieces.
    """
    return budgeted.withColumn(
        "pieces", splitting.split_column(F.col("content"), F.col("budget"), overlap)
    )


def number_entries(with_pieces: DataFrame, earlier: int = 0) -> DataFrame:
    """Add ``first_number``: how many chunks all earlier entries have, over all files, and
    ``earlier`` ones of runs before.

    The order is (source_file, entry_pos). ``with_pieces`` is read twice; hand in a
    table in buckets of ``source_file``. Then only one row per file moves: its count,
    and the number of chunks of all files before it.
    """
    n_pieces = F.sum(F.size("pieces"))
    counts = with_pieces.groupBy("source_file").agg(n_pieces.alias("n_pieces"))
    starts = running_start(counts, ["source_file"], "n_pieces").select(
        "source_file", F.col("running_start").alias("file_start")
    )
    before = (
        Window.partitionBy("source_file").orderBy("entry_pos").rowsBetween(Window.unboundedPreceding, -1)
    )
    in_file = with_pieces.withColumn("in_file", F.coalesce(n_pieces.over(before), F.lit(0)))
    return in_file.join(starts, "source_file").select(
        *with_pieces.columns, F.expr(f"file_start + in_file + {earlier}L").alias("first_number")
    )


def chunk_texts(with_pieces: DataFrame, *carried: str) -> DataFrame:
    """One row per piece, with the text of the chunk and its sizes, without ids."""
    pieces = with_pieces.selectExpr(
        "source_file",
        "entry_pos",
        f"coalesce(metadata.title, '{UNKNOWN_TITLE}') as title",
        f"coalesce(metadata.full_path, metadata.title, '{UNKNOWN_TITLE}') as full_path",
        "background",
        *carried,
        "posexplode(pieces) as (chunk_index, piece)",
    )
    texts = pieces.selectExpr(
        "*",
        f"""case when background <> '' then concat(background, '{PART_SEPARATOR}', piece)
                 else piece end as content""",
    )
    return texts.selectExpr(
        "source_file",
        "entry_pos",
        "chunk_index",
        "title",
        "full_path",
        "content",
        "length(content) as chunk_size",
        "length(background) as background_size",
        "length(piece) as content_size",
        *carried,
    )


def build_chunks(numbered: DataFrame) -> DataFrame:
    """Chunks: (source_file, entry_pos, chunk_index, chunk_number, stable_id, content, metadata).

    ``chunk_id`` counts over the whole run, so a new file renumbers later ones;
    ``stable_id`` depends on the chunk alone.
    """
    named = chunk_texts(numbered, "first_number").withColumns(
        {
            "chunk_number": F.expr("first_number + chunk_index + 1"),
            "stem": text.stem("source_file"),
            "clean_title": text.clean_title("title"),
        }
    )
    return named.selectExpr(
        "source_file",
        "entry_pos",
        "chunk_index",
        "chunk_number",
        "sha2(concat_ws('\x1f', source_file, full_path, entry_pos, chunk_index, content), 256) as stable_id",
        "content",
        f"""struct(
            format_string('{CHUNK_ID}', chunk_number, stem, clean_title, chunk_index) as chunk_id,
            source_file,
            full_path,
            chunk_size,
            background_size,
            content_size) as metadata""",
    )


def chunk_stats(
    with_pieces: DataFrame,
    chunk_size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
    files: DataFrame | None = None,
) -> DataFrame:
    """Per file: entries, chunks, their characters, average chunk size (0 without chunks).

    One pass over the entries with their pieces; no chunk text is built for it.
    With ``files`` (source_file), files without entries get a row of zeros.
    """
    before_piece = f"if(background = '', 0, length(background) + {len(PART_SEPARATOR)})"
    chunked = f"aggregate(pieces, 0L, (sum, p) -> sum + length(p) + {before_piece})"
    per_file = (
        with_pieces.selectExpr(
            "source_file",
            "length(content) as chars",
            "size(pieces) as n_pieces",
            f"{chunked} as chunked",
        )
        .groupBy("source_file")
        .agg(
            F.count(F.lit(1)).alias("original_entries"),
            F.sum("n_pieces").alias("total_chunks"),
            F.sum("chars").alias("original_total_chars"),
            F.sum("chunked").alias("chunked_total_chars"),
        )
    )
    if files is not None:
        per_file = files.select("source_file").join(per_file, "source_file", "left").na.fill(0)
    return per_file.select(
        "source_file",
        F.concat(F.lit("chunks_"), text.stem("source_file"), F.lit(".json")).alias("output_file"),
        "original_entries",
        "total_chunks",
        "original_total_chars",
        "chunked_total_chars",
        _average_size().alias("average_chunk_size"),
        F.lit(chunk_size).alias("target_chunk_size"),
        F.lit(overlap).alias("overlap_size"),
    )


def _average_size() -> Column:
    return F.coalesce(
        F.try_divide(F.col("chunked_total_chars").cast("double"), F.col("total_chunks")), F.lit(0.0)
    )


def chunk_stats_total(
    stats: DataFrame, chunk_size: int = CHUNK_SIZE, max_background: int | None = None
) -> DataFrame:
    """Sums over all files; the average weighs every chunk alike."""
    sums = ["original_entries", "total_chunks", "original_total_chars", "chunked_total_chars"]
    totals = stats.agg(
        F.count(F.lit(1)).alias("files"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums]
    )
    return totals.select(
        "files",
        *sums,
        _average_size().alias("average_chunk_size"),
        F.lit(chunk_size).alias("target_chunk_size"),
        F.lit(background_limit(chunk_size, max_background)).alias("max_background_size"),
    )
