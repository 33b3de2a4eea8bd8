"""Incremental ingest: new files are inserted as they appear, chunk files or texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.functions.tokens import Counter
from docloom.operators import calls, chunking, documents
from docloom.operators import collection as coll
from docloom.plans import stages
from docloom.schemas import REJECT
from docloom.shared import write_stage
from docloom.sources import files

INPUT_ORDER = ["input_file", "item_pos"]


def _add_rejects(spark: SparkSession, rejects: DataFrame, name: str) -> None:
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], REJECT).write.format("parquet").saveAsTable(name)
    fresh = rejects.join(spark.table(name), ["source_file", "reason"], "left_anti")
    write_stage(fresh, "rejects").write.mode("append").format("parquet").saveAsTable(name)
    spark.catalog.refreshTable(name)


def _arriving(spark: SparkSession, path: str, glob: str, files_per_batch: int | None) -> DataFrame:
    stream = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", glob)
    )
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return stream.load(path).select(F.substring_index("path", "/", -1).alias("source_file"), "content")


def _run(arrived: DataFrame, insert: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        arrived.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_chunk_files(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    embed: coll.Embed,
    name: str = coll.COLLECTION_NAME,
) -> StreamingQuery:
    """Insert the chunks of files not seen yet, then stop.

    Rows are told by file, place and content. A batch that runs again after a failure
    finds its rows stored and adds nothing, also of rows without an id, so the insert
    is idempotent. Files that can't be read or parsed are listed, with the reason, in
    the table ``{name}_rejects``.
    """

    def insert(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        texts, unreadable = files.texts_of(batch)
        chunks, broken = files.chunks_of(texts)
        parts = F.concat_ws("\0", "input_file", F.col("item_pos").cast("string"), "document")
        rows = coll.chunk_rows(chunks, "metadata_json", *INPUT_ORDER).withColumn("stable_id", F.sha2(parts, 256))
        coll.add_chunks(session, rows, embed, name, order=INPUT_ORDER, key="stable_id")
        _add_rejects(session, unreadable.unionByName(broken), f"{name}_rejects")

    return _run(_arriving(spark, path, files.JSON_GLOB, None), insert, checkpoint)


#: Which numbers the chunks of each batch have.
BATCHES = "progress string, batch_id long, first_number long, chunks long"


def _first_number(spark: SparkSession, table: str, progress: str, batch_id: int) -> tuple[int, bool]:
    """How many chunks come before those of a batch, and whether the batch has ended before.

    A batch that runs again has the number it had. A stream that begins anew, without its
    progress log, goes on behind all numbers there are.
    """
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], BATCHES).write.format("parquet").saveAsTable(table)
    spark.catalog.refreshTable(table)
    rows = spark.table(table)
    own = (F.col("progress") == progress) & (F.col("batch_id") == batch_id)
    known = rows.where(own).select("first_number").first()
    if known is not None:
        return known.first_number, True
    return rows.agg(F.max(F.expr("first_number + chunks"))).first()[0] or 0, False


def ingest_texts(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    embed: coll.Embed,
    name: str = coll.COLLECTION_NAME,
    convert: documents.Converter | Callable[[str], str] | None = None,
    memory: calls.Memory | None = None,
    retry: calls.Retry = calls.Retry(),
    max_tokens: int = documents.MAX_TOKENS,
    counter: Counter | None = None,
    chunk_size: int = chunking.CHUNK_SIZE,
    overlap: int = chunking.OVERLAP,
    max_background: int | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Take text files not seen yet all the way into the collection, then stop: packed,
    converted, cut into sections and chunks, numbered, embedded.

    Chunks are numbered on from those of earlier batches, within a batch by file name, so
    files that arrive in the order of their names get the numbers that one run over all of
    them gives. Which numbers a batch has is kept in the table ``{name}__batches``. Rows are
    told by their stable ids: a batch that runs again, or a stream without its progress log,
    adds nothing that is stored. Hand in a ``memory`` for ``convert``, and for ``embed``, so
    that neither is called again for what a failed batch had done. Files that aren't UTF-8
    are listed in ``{name}_rejects``.
    """
    batches = f"{name}__batches"

    def insert(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        arrived = write_stage(batch, "arrived")
        texts, unreadable = files.texts_of(arrived)
        earlier, ended = _first_number(session, batches, checkpoint, batch_id)
        md = stages.texts_to_markdown(texts, max_tokens, convert, counter, memory, retry)
        chunks = stages.markdown_to_chunks(md, chunk_size, overlap, max_background, earlier)
        rows = coll.chunk_rows(chunks, "stable_id").withColumn("metadata_json", F.to_json("metadata"))
        rows = write_stage(rows, "rows")
        coll.add_chunks(session, rows, embed, name, key="stable_id")
        _add_rejects(session, unreadable, f"{name}_rejects")
        if not ended:
            done = session.createDataFrame([(checkpoint, batch_id, earlier, rows.count())], BATCHES)
            done.write.mode("append").format("parquet").saveAsTable(batches)

    return _run(_arriving(spark, path, files.TEXT_GLOB, files_per_batch), insert, checkpoint)
