"""Explicit schemas of the tables that pass between the stages."""

from pyspark.sql import types as T

PAGE = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ]
)

DOC = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

ENTRY_METADATA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("hierarchy", T.ArrayType(T.StringType())),
        T.StructField("full_path", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("content_length", T.IntegerType()),
        T.StructField("word_count", T.IntegerType()),
    ]
)

ENTRY_JSON = T.StructType(
    [
        T.StructField("content", T.StringType()),
        T.StructField("metadata", ENTRY_METADATA),
    ]
)

ENTRY = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("entry_pos", T.IntegerType()),
        *ENTRY_JSON.fields,
    ]
)

CHUNK_METADATA = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("full_path", T.StringType()),
        T.StructField("chunk_size", T.IntegerType()),
        T.StructField("background_size", T.IntegerType()),
        T.StructField("content_size", T.IntegerType()),
    ]
)

CHUNK_JSON = T.StructType(
    [
        T.StructField("content", T.StringType()),
        T.StructField("metadata", CHUNK_METADATA),
    ]
)

COLLECTION = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("stable_id", T.StringType()),
        T.StructField("document", T.StringType()),
        T.StructField("metadata", CHUNK_METADATA),
        T.StructField("metadata_json", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("embedding_missing", T.BooleanType()),
    ]
)

REJECT = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)
