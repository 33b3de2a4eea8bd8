"""What several operators share: keys of documents and tables in the shared folder."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.shared import write_stage

#: What a word is: a run of anything but space and \x09 to \x0D.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of an Arrow batch while a stage is written.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Bytes of the texts of a batch that Python takes in at a time. Where a table is not
#: written by ``stage``, the caller's settings make the batches, which may be large.
SHARE_BYTES = 1 << 20

#: Stands for a null id where rows are compared; ids are ordered with null first.
NULL_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Later reads then depend on files that every executor sees, not on shuffle files of
    executors that may be lost. While it is written, texts go to Python in batches of
    ``BATCH_BYTES``: a task holds several copies of a batch outside the heap.
    """
    conf = df.sparkSession.conf
    before = conf.get(_BATCH_CONF)
    conf.set(_BATCH_CONF, str(BATCH_BYTES))
    try:
        return write_stage(df, re.sub(r"\W", "_", name))
    finally:
        conf.set(_BATCH_CONF, before)


def doc_key(text: str, doc_id: str = "doc_id") -> list[Column]:
    """Columns ``doc`` and ``mark`` that name a document.

    Rows of one id and one text count as the same document; rows of one id and several
    texts are told apart by ``mark``, 31 bits of the text's hash.
    """
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("doc"),
        F.xxhash64(F.col(text)).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("mark"),
    ]


def sizes(data: pa.Array) -> np.ndarray:
    """Bytes of each value of a binary column; null has none."""
    return pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def shares(size: np.ndarray, most: int = SHARE_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of successive rows of up to ``most`` bytes in all, or of one larger row."""
    ends = np.cumsum(size)
    first = 0
    while first < len(size):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield first, last
        first = last


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        at = batch.schema.get_field_index("data")
        for first, last in shares(sizes(batch.column(at))):
            part = batch.slice(first, last - first)
            data = [packer.compress(x.as_py() or b"") for x in part.column(at)]
            yield part.set_column(at, "data", pa.array(data, pa.binary()))


def packed(keyed: DataFrame) -> DataFrame:
    """Compress the column ``data`` for a shuffle, in which it takes a third less room
    than under the shuffle's own fast compression."""
    return keyed.mapInArrow(_pack, keyed.schema)


def packed_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose column ``data`` unpacks to ``SHARE_BYTES``, or to one
    larger text."""
    for batch in batches:
        # a frame written in one piece holds its size
        size = [zstandard.frame_content_size(x.as_py()) for x in batch.column("data")]
        for first, last in shares(np.array(size, np.int64)):
            yield batch.slice(first, last - first)


def unpacked(batch: pa.RecordBatch) -> pa.Array:
    """The column ``data`` of a batch as it was before ``packed``."""
    unpacker = zstandard.ZstdDecompressor()
    return pa.array([unpacker.decompress(x.as_py()) for x in batch.column("data")], pa.large_binary())
