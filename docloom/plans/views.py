"""Inputs of the engine derived from the test tables.

The tables hold no markdown, so conversations are written up as documents: the
role gives the heading level, ten conversations share a file, and titles repeat;
some turns are followed by a section that is too short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.schemas import CHUNK_METADATA
from docloom.shared import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MD_BLOCK = """
    concat(
      repeat('#', case role when 'system' then 1 when 'user' then 2 else 3 end), ' ',
      case when (conv_id * 3 + turn) % 7 = 0 then 'References'
           when (conv_id + turn) % 11 = 0 then 'Flow index'
           when turn % 5 = 4 then 'Overview'
           when (conv_id + 2 * turn) % 4 = 0 and trim(split_part(text, '.', 1)) <> ''
             then replace(split_part(text, '.', 1), char(10), ' ')
           else concat('Topic ', conv_id, ' ', turn) end,
      char(10),
      text,
      case when (conv_id + turn) % 9 = 0 then '\n\n#### Aside\nshort' else '' end)
"""


def md_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = table(spark, sf_dir, "conversations").selectExpr(
        "concat('file_', conv_id div 10, '.json') as source_file",
        "conv_id",
        "turn",
        f"{MD_BLOCK} as block",
    )
    return blocks.groupBy("source_file").agg(
        F.expr("listagg(block, '\n\n') within group (order by conv_id, turn)").alias("md")
    )


def doc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as paged documents; some pages, and some whole documents, are empty."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "concat('doc_', conv_id, '.txt') as doc_id",
        "cast(turn as int) as page_no",
        "case when turn % 4 = 3 or conv_id % 25 = 7 then '' else text end as text",
    )


def doc_texts(spark: SparkSession, sf_dir: str, labelled: bool = False) -> DataFrame:
    """One file per document, or labelled document, as it is: a single paragraph."""
    docs = table(spark, sf_dir, "documents")
    if labelled:
        docs = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return spread(docs.selectExpr("concat('doc_', doc_id, '.txt') as source_file", "text"))


def doc_paragraphs(spark: SparkSession, sf_dir: str, labelled: bool = False) -> DataFrame:
    """The same files with every line a paragraph."""
    return doc_texts(spark, sf_dir, labelled).select(
        "source_file", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text")
    )


def source_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").selectExpr("source as source_file", "text"))


CHUNK_ID = "format_string('chunk_%06d', {})"


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a chunk row."""
    return table(spark, sf_dir, "documents").selectExpr(
        f"{CHUNK_ID.format('doc_id')} as chunk_id",
        "text as document",
        "named_struct('source_file', source, 'full_path', lang) as metadata",
    )


def chunk_metadata() -> Column:
    """The metadata of ``incoming`` with all the fields that a collection has."""
    given = {"source_file", "full_path"}
    fields = [
        (F.col(f"metadata.{f.name}") if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in CHUNK_METADATA
    ]
    return F.struct(*fields).alias("metadata")


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection that holds an older version of the labelled documents."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return docs.join(labels, "doc_id", "left_semi").selectExpr(
        f"{CHUNK_ID.format('doc_id')} as chunk_id",
        "concat('old ', text) as document",
        "named_struct('source_file', source, 'full_path', lang) as metadata",
        "array_repeat(cast(0 as float), 64) as embedding",
        "true as embedding_missing",
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").selectExpr(
        f"{CHUNK_ID.format('vec_id')} as chunk_id", "embedding", "label"
    )


def vectors_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").selectExpr(
        f"{CHUNK_ID.format('vec_id')} as chunk_id",
        """case vec_id % 7 when 1 then null when 2 then slice(embedding, 1, 9)
             when 3 then transform(embedding, (x, i) -> if(i = 5, cast('NaN' as float), x))
             else embedding end as embedding""",
    )


def searchable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection of all vectors, with the document of the same id where there is one."""
    return vectors(spark, sf_dir).join(incoming(spark, sf_dir), "chunk_id", "left").select(
        "chunk_id",
        F.coalesce("document", F.lit("")).alias("document"),
        "metadata",
        "embedding",
    )


def centroids(spark: SparkSession, sf_dir: str, by: str | None = "label") -> DataFrame:
    """Query vectors: the mean vector of each label, or of the whole table."""
    cells = table(spark, sf_dir, "embeddings").select(
        (F.col(by) if by else F.lit(0)).alias("query_id"), F.posexplode("embedding").alias("i", "x")
    )
    means = cells.groupBy("query_id", "i").agg(F.avg("x").alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    return means.groupBy("query_id").agg(F.transform(ordered, lambda c: c["x"]).alias("embedding"))


def chunk_file_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk files as texts, one per conversation, and beside them some that hold no array."""
    item = F.expr(
        """named_struct(
            'content', text,
            'metadata', named_struct(
                'chunk_id', case when role <> 'system' then format_string('chunk_%06d_%d', conv_id, turn) end,
                'source_file', concat('conv_', conv_id, '.json'),
                'chunk_size', length(text)))"""
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", item.alias("item"))
    files = rows.groupBy("conv_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("turn", "item"))), lambda x: x["item"]
        ).alias("items")
    )
    array = F.to_json("items")

    def file(name: str, content: Column) -> Column:
        path = F.concat(F.lit(name), "conv_id", F.lit(".json"))
        return F.struct(path.alias("source_file"), content.alias("text"))

    last = F.col("conv_id") % 10
    beside = F.when(last == 3, file("lone_", F.to_json(F.col("items")[0]))).when(
        last == 6, file("oops_", F.concat(F.lit("oops "), array))
    )
    both = F.array_compact(F.array(file("chunks_conv_", array), beside))
    return files.select(F.inline(both))
