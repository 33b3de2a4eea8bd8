"""File scans and sinks. Every scan yields good rows and rejected files."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions import text
from docloom.schemas import CHUNK_JSON, ENTRY_JSON
from docloom.sources import listing
from docloom.sources.named import NamedFiles

# Python's parser takes neither single quotes nor comments nor leading zeros.
STRICT_JSON = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}

# Fixed values.
PDF_GLOB = "*.[pP][dD][fF]"
TEXT_GLOB = "*.txt"
MARKDOWN_GLOB = "*.md"
JSON_GLOB = "*.json"

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def _binary(spark: SparkSession, path: str, glob: str, recursive: bool = False) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )


def _file_name(path: str, recursive: bool = False) -> Column:
    """A file's own name; with subfolders its path below the folder, or else the whole
    path, so that files of the same name stay apart."""
    if not recursive:
        # not that of the file's metadata, in which spaces and brackets are escaped
        return F.substring_index("path", "/", -1).alias("source_file")
    root, whole = _root(path), F.regexp_replace("path", _SCHEME, "")
    at = F.instr(whole, root)
    below = F.substr(whole, at + F.lit(len(root)))
    return F.when(at > 0, below).otherwise(whole).alias("source_file")


def _root(path: str) -> str:
    return re.sub(_SCHEME, "", path).rstrip("/") + "/"


def _listed_name(file: str, path: str, recursive: bool) -> str:
    """``_file_name`` of a file in the scan's index."""
    whole = re.sub(_SCHEME, "", unquote(file))
    if not recursive:
        return whole.rsplit("/", 1)[-1]
    _, root, below = whole.partition(_root(path))
    return below if root else whole


def list_sources(spark: SparkSession, path: str, glob: str = PDF_GLOB) -> DataFrame:
    """Files of one folder, not its subfolders; their bytes are not read."""
    return _binary(spark, path, glob).select(_file_name(path), "path", "length")


def read_texts(
    spark: SparkSession,
    path: str,
    glob: str = TEXT_GLOB,
    recursive: bool = False,
    include_empty: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Whole files as (source_file, text), and those that are not valid UTF-8.

    Spark's scans leave out files of length 0. ``include_empty`` lists the folder by tasks
    to find them; for a path that is a pattern, or in a store that Arrow doesn't reach, it
    takes the names from the scan's index, on the driver.
    """
    files = _binary(spark, path, glob, recursive).select(_file_name(path, recursive), "content")
    good, rejects = texts_of(files)
    if include_empty:
        empty = _empty_files(spark, files, path, glob, recursive)
        good = good.unionByName(empty.withColumn("text", F.lit("")))
    return good, rejects


def _empty_files(
    spark: SparkSession, files: DataFrame, path: str, glob: str, recursive: bool
) -> DataFrame:
    """(source_file) of the files of length 0; ``files`` is the scan of the others."""
    if listing.reaches(spark, path):
        found = listing.list_files(spark, path, glob, recursive).where("length = 0")
        return found.select(F.col("below").alias("source_file"))
    names = [(_listed_name(f, path, recursive),) for f in files.inputFiles()]
    listed = spark.createDataFrame(names, "source_file string")
    return listed.join(files.select("source_file"), "source_file", "left_anti")


def texts_of(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source_file, content as bytes) -> texts with plain line ends, and invalid files."""
    decoded = F.col("content").cast("string")
    valid = F.is_valid_utf8(decoded)
    good = files.where(valid).select("source_file", text.unify_newlines(decoded).alias("text"))
    return good, files.where(~valid).select("source_file", F.lit("not UTF-8").alias("reason"))


def read_markdown(
    spark: SparkSession, path: str, recursive: bool = False
) -> tuple[DataFrame, DataFrame]:
    docs, rejects = read_texts(spark, path, MARKDOWN_GLOB, recursive)
    return docs.withColumnRenamed("text", "md"), rejects


def parse_json_arrays(
    docs: DataFrame, element: T.StructType, whole: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(source_file, text) -> (source_file, items) of files that hold an array of objects.

    With ``whole``, ``whole`` holds that field of every object as JSON, with all that the
    element's schema doesn't name.

    A lone object would parse as an array of one, hence the test for the bracket. The
    parser stops behind the array and doesn't see what follows, hence the frame: in an
    array of the text and an element that no text can hold, its own hash, there must be
    these two.
    """
    kept = [whole] if whole else []
    end = F.sha2("text", 256)
    framed = F.from_json(
        F.concat(F.lit("["), "text", F.lit(',"'), end, F.lit('"]')), "array<string>", STRICT_JSON
    )
    alone = (F.size(framed) == 2) & (F.get(framed, F.lit(1)) == end)
    parsed = docs.select(
        "source_file",
        F.startswith(text.strip("text"), F.lit("[")).alias("is_array"),
        F.from_json("text", T.ArrayType(element), STRICT_JSON).alias("items"),
        F.coalesce(alone, F.lit(False)).alias("alone"),
        *[F.from_json("text", f"array<struct<{f}: string>>", STRICT_JSON)[f].alias("whole") for f in kept],
    )
    reason = F.when(F.col("items").isNull() | ~F.col("alone"), F.lit("not JSON")).when(
        ~F.col("is_array"), F.lit("not an array")
    )
    judged = parsed.withColumn("reason", reason)
    good = judged.where(F.col("reason").isNull()).select("source_file", "items", *["whole" for _ in kept])
    rejects = judged.where(F.col("reason").isNotNull()).select("source_file", "reason")
    return good, rejects


def entries_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source_file, text) -> entries in array order.

    One entry without content or metadata rejects its whole file.
    """
    arrays, rejects = parse_json_arrays(docs, ENTRY_JSON)
    complete = F.forall(
        "items", lambda e: e["content"].isNotNull() & e["metadata"].isNotNull()
    )
    good = arrays.where(complete).select(
        "source_file", F.posexplode("items").alias("entry_pos", "item")
    )
    broken = arrays.where(~complete).select(
        "source_file", F.lit("entry without content or metadata").alias("reason")
    )
    entries = good.select("source_file", "entry_pos", "item.content", "item.metadata")
    return entries, rejects.unionByName(broken)


def read_entries(
    spark: SparkSession, path: str, recursive: bool = False, include_empty: bool = True
) -> tuple[DataFrame, DataFrame]:
    """All entries of all JSON files of a folder, and the files left out, empty ones too."""
    docs, unreadable = read_texts(spark, path, JSON_GLOB, recursive, include_empty)
    entries, rejects = entries_of(docs)
    return entries, unreadable.unionByName(rejects)


def chunks_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source_file, text) -> chunks (input_file, item_pos, content, metadata, metadata_json).

    ``metadata`` has the fields of the schema, ``metadata_json`` all there are.
    """
    arrays, rejects = parse_json_arrays(docs, CHUNK_JSON, "metadata")
    items = arrays.select(
        F.col("source_file").alias("input_file"),
        F.posexplode(F.arrays_zip("items", "whole")).alias("item_pos", "item"),
    )
    chunks = items.select(
        "input_file",
        "item_pos",
        "item.items.content",
        "item.items.metadata",
        F.col("item.whole").alias("metadata_json"),
    )
    return chunks, rejects


def load_chunks(
    spark: SparkSession, path: str, recursive: bool = False, include_empty: bool = True
) -> tuple[DataFrame, DataFrame]:
    """All chunks of all JSON files of a folder, and the files left out, empty ones too."""
    docs, unreadable = read_texts(spark, path, JSON_GLOB, recursive, include_empty)
    chunks, rejects = chunks_of(docs)
    return chunks, unreadable.unionByName(rejects)


def to_json_arrays(rows: DataFrame, name: Column, order: list[str], files: DataFrame | None = None) -> DataFrame:
    """(content, metadata) rows -> (output_name, text), one JSON array per file.

    With ``files`` (output_name), a file without rows yields an empty array.
    """
    item = F.struct(*[F.col(c) for c in order], F.struct("content", "metadata").alias("item"))
    items = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["item"])
    arrays = rows.groupBy(name.alias("output_name")).agg(
        F.to_json(items, {"ignoreNullFields": "false"}).alias("text")
    )
    if files is None:
        return arrays
    return (
        files.select("output_name")
        .join(arrays, "output_name", "left")
        .select("output_name", F.coalesce("text", F.lit("[]")).alias("text"))
    )


def text_files(docs: DataFrame) -> DataFrame:
    name = F.concat(text.stem("source_file"), F.lit(".txt"))
    return docs.select(name.alias("output_name"), "text")


def markdown_files(md_docs: DataFrame) -> DataFrame:
    name = F.concat(text.stem("source_file"), F.lit(".md"))
    return md_docs.select(name.alias("output_name"), F.col("md").alias("text"))


def entry_files(entries: DataFrame) -> DataFrame:
    """Files without entries are not written."""
    name = F.concat(text.stem("source_file"), F.lit(".json"))
    return to_json_arrays(entries, name, ["entry_pos"])


def chunk_files(chunks: DataFrame, sources: DataFrame) -> DataFrame:
    """Every source file gets its chunk file, also without chunks."""
    name = F.concat(F.lit("chunks_"), text.stem("source_file"), F.lit(".json"))
    files = sources.select(name.alias("output_name")).distinct()
    return to_json_arrays(chunks, name, ["entry_pos", "chunk_index"], files)


def write_named(files: DataFrame, path: str, mode: str = "append") -> None:
    """(output_name, text) -> one file per row, ``{path}/{output_name}``; all of them or none.

    ``"append"`` refuses names that are taken, ``"overwrite"`` replaces those files and no
    others. The scans read them back, those with subfolders if names have them. Stores that
    Arrow doesn't reach take ``write_files``.
    """
    files.sparkSession.dataSource.register(NamedFiles)
    named = files.select(F.col("output_name").cast("string"), F.col("text").cast("string"))
    named.write.format(NamedFiles.name()).mode(mode).save(path)


def write_files(files: DataFrame, path: str) -> None:
    """(output_name, text) -> one folder per name, holding the text in one part file.

    The part files carry the output name's suffix only in the folder name, so
    read them back with ``read_file_folders``, which takes off the line end that the
    writer puts behind a text. Names are expected to be distinct.
    """
    files.write.mode("errorifexists").partitionBy("output_name").option("lineSep", "\n").text(path)


def read_file_folders(spark: SparkSession, path: str) -> DataFrame:
    """Read what ``write_files`` wrote, as (source_file, text)."""
    return (
        spark.read.schema("value string, output_name string")
        .text(path, wholetext=True)
        .selectExpr("output_name as source_file", "left(value, length(value) - 1) as text")
    )
