"""One query per operator, over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import boilerplate, splitting, text
from docloom.functions.tokens import PythonCounter
from docloom.operators import calls, cells, chunking, collection, documents, outline, search
from docloom.plans import stages, views
from docloom.shared import shared_dir, write_stage
from docloom.sources import files

Query = Callable[[SparkSession, str], DataFrame]

CHUNKING = {"chunk_size": 600, "overlap": 50}
TIGHT_CHUNK_SIZE, TIGHT_BACKGROUND = 210, 180
SEGMENT_TOKENS = 200
DIM = 64
CELLS = 16


def _headings(spark, sf):
    return outline.parse_headings(views.md_docs(spark, sf))


def _entries(spark, sf):
    return outline.markdown_to_entries(views.md_docs(spark, sf))


def _pieces(spark, sf):
    return stages.markdown_to_pieces(views.md_docs(spark, sf), **CHUNKING)


def heading_normalize(spark, sf):
    return _headings(spark, sf).select(
        "source_file", "pos", text.normalize_heading("title").alias("normalized")
    )


def heading_technical(spark, sf):
    return _headings(spark, sf).select(
        "source_file",
        "pos",
        boilerplate.is_technical(text.normalize_heading("title")).alias("is_technical"),
    )


def toc_flag(spark, sf):
    return outline.flag_boilerplate(_headings(spark, sf)).select(
        "source_file", "pos", "title", "is_toc"
    )


def fuzzy_keywords(spark, sf):
    """Keywords from a table: the first two words of every item of the benchmark."""
    first = F.regexp_extract("text", "[^ \n]+[ \n][^ \n]+", 0)
    items = views.table(spark, sf, "benchmark").select(first.alias("start"))
    keywords = items.select(text.normalize_heading("start").alias("keyword"))
    return outline.flag_boilerplate(_headings(spark, sf), keywords).select(
        "source_file", "pos", "title", "is_toc"
    )


def skip_subtree(spark, sf):
    flagged = outline.flag_boilerplate(_headings(spark, sf))
    return outline.flag_skipped(flagged).select("source_file", "pos", "level", "skipped")


def _sections(spark, sf):
    return outline.sections(outline.skip_subtrees(outline.flag_boilerplate(_headings(spark, sf))))


def hierarchy(spark, sf):
    return outline.hierarchy(_sections(spark, sf)).select(
        "source_file", "entry_pos", "pos", F.array_join("hierarchy", " | ").alias("hierarchy")
    )


ENTRY_COLUMNS = (
    "source_file",
    "entry_pos",
    "content",
    "metadata.title",
    "metadata.full_path",
    "metadata.level",
    "metadata.content_length",
    "metadata.word_count",
)


def entries(spark, sf):
    return _entries(spark, sf).select(*ENTRY_COLUMNS)


def _written(output, name):
    """Output files, written as a table and read back as the input of the next scan."""
    return write_stage(output, name).withColumnRenamed("output_name", "source_file")


def text_roundtrip(spark, sf):
    return _written(files.text_files(views.doc_texts(spark, sf)), "text-files")


def entry_roundtrip(spark, sf):
    read, _ = files.entries_of(_written(files.entry_files(_entries(spark, sf)), "entry-files"))
    return read.select(*ENTRY_COLUMNS)


def chunk_roundtrip(spark, sf):
    named = stages.number_chunks(_pieces(spark, sf))
    output = files.chunk_files(named, views.md_docs(spark, sf))
    read, _ = files.chunks_of(_written(output, "chunk-files"))
    return read.select("input_file", "item_pos", "content", "metadata.*")


def entry_summary(spark, sf):
    return outline.entry_summary(_entries(spark, sf)).withColumn(
        "words_per_entry", F.round("words_per_entry", 6)
    )


def background(spark, sf):
    table = write_stage(_entries(spark, sf), "entries")
    return chunking.with_background(table, CHUNKING["chunk_size"]).select(
        "source_file", "entry_pos", "background"
    )


def chunk_budget(spark, sf):
    with_bg = chunking.entries_with_background(
        _sections(spark, sf), TIGHT_CHUNK_SIZE, TIGHT_BACKGROUND
    )
    return chunking.with_budget(with_bg, TIGHT_CHUNK_SIZE).select(
        "source_file", "entry_pos", "background", "budget"
    )


def chunk_split(spark, sf):
    """Whole documents at the default chunk size and overlap."""
    pieces = splitting.split_column(
        F.col("text"), F.lit(chunking.CHUNK_SIZE), chunking.OVERLAP
    )
    return (
        views.doc_texts(spark, sf)
        .select("source_file", pieces.alias("pieces"))
        .select("source_file", F.posexplode("pieces").alias("piece_idx", "piece"))
    )


def chunks(spark, sf):
    return chunking.chunk_texts(_pieces(spark, sf)).drop("title")


def chunk_ids(spark, sf):
    return stages.number_chunks(_pieces(spark, sf)).select(
        "source_file", "entry_pos", "chunk_index", "chunk_number", "metadata.chunk_id", "stable_id"
    )


def chunk_stats(spark, sf):
    return chunking.chunk_stats(_pieces(spark, sf), **CHUNKING).withColumn(
        "average_chunk_size", F.round("average_chunk_size", 6)
    )


def chunk_stats_total(spark, sf):
    stats = chunking.chunk_stats(_pieces(spark, sf), **CHUNKING)
    return chunking.chunk_stats_total(stats, CHUNKING["chunk_size"]).withColumn(
        "average_chunk_size", F.round("average_chunk_size", 6)
    )


def page_concat(spark, sf):
    return documents.concat_pages(views.doc_pages(spark, sf))


def token_counts(spark, sf):
    return documents.token_counts(views.doc_texts(spark, sf))


def token_rollup(spark, sf):
    return documents.token_report(views.source_texts(spark, sf))


def token_segments(spark, sf):
    return documents.pack_segments(views.doc_paragraphs(spark, sf), SEGMENT_TOKENS)


def token_segments_sentences(spark, sf):
    return documents.pack_segments(views.doc_texts(spark, sf), SEGMENT_TOKENS)


def token_segments_quarter(spark, sf):
    """Packed by a counter in Python whose counts don't add up: four characters a token."""
    counter = PythonCounter(lambda text: len(text) // 4, monotone=True)
    return documents.pack_segments(views.doc_paragraphs(spark, sf), SEGMENT_TOKENS, counter)


def convert_remembered(spark, sf):
    """Labelled documents are converted first, then all with the results of that."""
    memory = calls.Memory(f"{shared_dir(spark)}/memory-{uuid.uuid4().hex}", "quote")
    docs, labelled = views.doc_paragraphs(spark, sf), views.doc_paragraphs(spark, sf, labelled=True)

    def convert(text):
        return f"> {text}"

    stages.texts_to_markdown(labelled, SEGMENT_TOKENS, convert, memory=memory)
    return stages.texts_to_markdown(docs, SEGMENT_TOKENS, convert, memory=memory)


def md_reassemble(spark, sf):
    return stages.texts_to_markdown(views.doc_paragraphs(spark, sf), SEGMENT_TOKENS)


def success_rate(spark, sf):
    """A converter that fails on segments with an at sign."""

    def convert(c):
        return F.struct(c.alias("md"), (F.instr(c, "@") == 0).alias("ok"))

    docs = views.doc_paragraphs(spark, sf)
    segments = documents.pack_segments(docs, SEGMENT_TOKENS)
    _, rejects = files.chunks_of(views.chunk_file_texts(spark, sf))
    return documents.success_rate(documents.transform_segments(segments, convert), docs, rejects)


def existing_ids(spark, sf):
    return collection.existing_ids(views.incoming(spark, sf))


def collection_info(spark, sf):
    return collection.collection_info(views.incoming(spark, sf), "document_chunks", "warehouse")


def filter_new_chunks(spark, sf):
    rows = collection.new_chunks(views.incoming(spark, sf), views.stored(spark, sf))
    return rows.select("chunk_id", "document")


def default_ids(spark, sf):
    """Documents without a label have no id; some default ids are stored already."""
    labels = views.table(spark, sf, "labels")
    docs = views.table(spark, sf, "documents").select("doc_id", F.col("text").alias("document"))
    named = labels.select("doc_id", F.concat(F.lit("doc_"), "doc_id").alias("chunk_id"))
    rows = docs.join(named, "doc_id", "left").select("chunk_id", "document", "doc_id")
    toxic = labels.where("toxic = 1").select(F.concat(F.lit("doc_"), "doc_id").alias("chunk_id"))
    taken = (
        views.table(spark, sf, "conversations")
        .select(F.concat(F.lit("chunk_"), "conv_id").alias("chunk_id"))
        .distinct()
    )
    return collection.with_default_ids(rows, toxic.union(taken), ["doc_id"])


def embed_attach(spark, sf):
    attached = collection.attach_vectors(
        views.incoming(spark, sf).select("chunk_id"), views.vectors(spark, sf), DIM
    )
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x)
    return attached.select(
        "chunk_id",
        "embedding_missing",
        F.size("embedding").alias("dim"),
        F.round(total, 6).alias("total"),
    )


def _insert(spark, sf, force):
    after = collection.collection_after(
        views.incoming(spark, sf),
        views.stored(spark, sf),
        lambda rows: collection.attach_vectors(rows, views.vectors(spark, sf), DIM),
        force,
    )
    return after.select("chunk_id", "document", "embedding_missing")


def _collection_of(spark, name, rows, embed):
    """A collection table that holds these rows."""
    fresh = f"{name}_{uuid.uuid4().hex}"
    collection.add_chunks(spark, rows, embed, fresh, key="stable_id")
    return fresh


def _documents(spark, sf, prefix=""):
    """Documents as rows with a stable id, which is that of the document."""
    rows = views.incoming(spark, sf).withColumn("stable_id", F.sha2("chunk_id", 256))
    return rows.select(
        F.concat(F.lit(prefix), "chunk_id").alias("chunk_id"), "stable_id", "document", views.chunk_metadata()
    )


def _embedding(spark, sf):
    return lambda rows: collection.attach_vectors(rows, views.vectors(spark, sf), DIM)


def upsert_partial(spark, sf):
    """A table of all documents, in which the toxic ones get another text."""
    rows, embed = _documents(spark, sf), _embedding(spark, sf)
    name = _collection_of(spark, "upsert", rows, embed)
    toxic = views.table(spark, sf, "labels").where("toxic = 1")
    ids = toxic.select(F.expr(views.CHUNK_ID.format("doc_id")).alias("chunk_id"))
    changed = rows.join(ids, "chunk_id", "left_semi").withColumn("document", F.lit("withdrawn"))
    after = collection.add_chunks(spark, changed, embed, name, "replace")
    return after.select("chunk_id", "document", "embedding_missing")


def insert_missing_stable(spark, sf):
    """Labelled documents are stored; then all come again under other ids."""
    labels = views.table(spark, sf, "labels")
    known = labels.select(F.expr(views.CHUNK_ID.format("doc_id")).alias("chunk_id"))
    stored = _documents(spark, sf).join(known, "chunk_id", "left_semi")
    embed = _embedding(spark, sf)
    name = _collection_of(spark, "stable", stored, embed)
    after = collection.add_chunks(spark, _documents(spark, sf, "again_"), embed, name, key="stable_id")
    return after.select("chunk_id", "stable_id", "document", "embedding_missing")


def load_chunks(spark, sf):
    """Chunk files are written to a table, read back and parsed."""
    loaded, _ = files.chunks_of(write_stage(views.chunk_file_texts(spark, sf), "chunk-files"))
    return loaded.select("input_file", "item_pos", "content", "metadata.chunk_id", "metadata.chunk_size")


def reject_files(spark, sf):
    _, rejects = files.chunks_of(views.chunk_file_texts(spark, sf))
    return rejects


def _rounded(hits):
    return hits.withColumn("distance", F.round("distance", 6))


def named_files(spark, sf):
    """Markdown documents and their entries as files of their own, read back by the scans."""
    path = f"{shared_dir(spark)}/named-{uuid.uuid4().hex}"
    docs = write_stage(views.md_docs(spark, sf), "md")
    entries = outline.markdown_to_entries(docs)
    files.write_named(files.markdown_files(docs), path)
    files.write_named(files.entry_files(entries), path)
    read, _ = files.read_markdown(spark, path)
    parsed, _ = files.read_entries(spark, path)
    counts = parsed.groupBy("source_file").agg(F.count(F.lit(1)).alias("entries"), F.sum(F.length("content")).alias("chars"))
    stem = F.regexp_replace("source_file", r"\.\w+$", "")
    return (
        read.select(stem.alias("name"), "md")
        .join(counts.select(stem.alias("name"), "entries", "chars"), "name", "left")
        .select("name", "md", "entries", "chars")
    )


def knn_single(spark, sf):
    vector = views.centroids(spark, sf, None).first().embedding
    return _rounded(search.nearest_single(vector, views.vectors(spark, sf)))


def knn_join(spark, sf):
    return _rounded(
        search.nearest(views.centroids(spark, sf), views.vectors(spark, sf), search.SAMPLE_K)
    )


def knn_join_many(spark, sf):
    """Every vector as a query against all vectors."""
    asked = views.table(spark, sf, "embeddings").selectExpr("vec_id as query_id", "embedding")
    return _rounded(search.nearest(asked, views.vectors(spark, sf), search.SAMPLE_K))


def knn_cells(spark, sf):
    """The queries of ``knn_join`` over an index of cells, and vectors of all widths."""
    stored = views.vectors_with_gaps(spark, sf)
    index = cells.build(stored, f"cells_{uuid.uuid4().hex}", CELLS)
    return _rounded(cells.nearest(views.centroids(spark, sf), index, search.SAMPLE_K))


def knn_join_gaps(spark, sf):
    """Vectors of which some are null, cut short, or have a NaN."""
    stored = views.vectors_with_gaps(spark, sf)
    return _rounded(search.nearest(views.centroids(spark, sf), stored, search.SAMPLE_K))


def _toy_embedding(texts):
    """How often eight letters occur, per thousand characters."""
    return [[1000.0 * t.count(c) / max(1, len(t)) for c in "aeinorst"] for t in texts]


def search_text(spark, sf):
    """Every item of the benchmark as a query against all documents."""
    embed = collection.embedder(_toy_embedding, 8)
    stored = write_stage(embed(views.incoming(spark, sf)), "searchable")
    items = views.table(spark, sf, "benchmark").selectExpr("item_id as query_id", "text as query")
    return _rounded(search.search_texts(items, stored, embed, search.SAMPLE_K))


def search_hydrated(spark, sf):
    stored = views.searchable(spark, sf)
    hits = search.nearest(views.centroids(spark, sf), stored, search.SAMPLE_K)
    return search.hydrate(hits, stored).select(
        "query_id",
        "rank",
        "chunk_id",
        "source",
        "path",
        "preview",
        F.round("similarity", 6).alias("similarity"),
    )


def queries() -> dict[str, Query]:
    return {
        "token_counts": token_counts,
        "token_rollup": token_rollup,
        "page_concat": page_concat,
        "token_segments": token_segments,
        "token_segments_sentences": token_segments_sentences,
        "token_segments_quarter": token_segments_quarter,
        "md_reassemble": md_reassemble,
        "convert_remembered": convert_remembered,
        "success_rate": success_rate,
        "headings": _headings,
        "heading_normalize": heading_normalize,
        "heading_technical": heading_technical,
        "toc_flag": toc_flag,
        "fuzzy_keywords": fuzzy_keywords,
        "skip_subtree": skip_subtree,
        "sections": _sections,
        "hierarchy": hierarchy,
        "entries": entries,
        "entry_summary": entry_summary,
        "background": background,
        "chunk_budget": chunk_budget,
        "chunk_split": chunk_split,
        "chunks": chunks,
        "chunk_ids": chunk_ids,
        "chunk_stats": chunk_stats,
        "chunk_stats_total": chunk_stats_total,
        "existing_ids": existing_ids,
        "collection_info": collection_info,
        "filter_new_chunks": filter_new_chunks,
        "default_ids": default_ids,
        "embed_attach": embed_attach,
        "insert_missing": partial(_insert, force=None),
        "insert_force": partial(_insert, force="replace"),
        "insert_force_ignore": partial(_insert, force="ignore"),
        "upsert_partial": upsert_partial,
        "insert_missing_stable": insert_missing_stable,
        "load_chunks": load_chunks,
        "reject_files": reject_files,
        "text_roundtrip": text_roundtrip,
        "entry_roundtrip": entry_roundtrip,
        "chunk_roundtrip": chunk_roundtrip,
        "named_files": named_files,
        "knn_single": knn_single,
        "knn_join": knn_join,
        "knn_join_many": knn_join_many,
        "knn_cells": knn_cells,
        "knn_join_gaps": knn_join_gaps,
        "search_text": search_text,
        "search_hydrated": search_hydrated,
    }
