"""Byte-level BPE with the tiktoken library and a local file of ranks.

A long text is encoded in parts that end where no match of the splitting pattern can
span: before white space that follows something else. Patterns that, like those of
byte-level BPE, take white space only at the head of a match have this property. Runs of white
space too long for the pattern's engine are matched here by the pattern's own rule: all
of the run, or all but its last character if something follows.

Decoding works on raw bytes, since one token may hold a part of a character.

Definitions. Null text counts as empty and has no ids. Bytes that aren't UTF-8 are
replaced before encoding. Special tokens are ordinary text. Each row is encoded on its
own, so repeated rows, ties and other columns don't matter; columns named like the new
ones are replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import shares, sizes

#: Characters of a text that are matched at once.
PART = 1 << 16
#: Runs of white space from this length on are matched outside the pattern.
LONG_SPACE = 1 << 14

_BOUNDARY = re.compile(r"(?<=\S)[ \t\r\n]")
# Unicode white space.
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_SPACE = re.compile(f"[{_SPACES}]{{{LONG_SPACE},}}")
_SPACE = re.compile(f"[{_SPACES}]")


def load(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file: a base64 token and its rank on every line."""
    with open(ranks, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _parts(text: str) -> Iterator[str]:
    """Parts of a text between which no match of the pattern spans."""
    at = 0
    while len(text) - at > PART:
        cut = _BOUNDARY.search(text, at + PART)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode_text(encoding: tiktoken.Encoding, text: str) -> list[int]:
    ids: list[int] = []
    for part in _parts(text):
        at = 0
        for run in _LONG_SPACE.finditer(part):
            ids += encoding.encode_ordinary(part[at : run.start()])
            at = run.end() if run.end() == len(part) else run.end() - 1
            ids += encoding._encode_single_piece(part[run.start() : at])
        ids += encoding.encode_ordinary(part[at:])
    return ids


def _encoded(batches: Iterator[pa.Array], encoding: tiktoken.Encoding) -> Iterator[pa.Array]:
    for batch in batches:
        for first, last in shares(sizes(batch)):
            texts = ((x.as_py() or b"").decode("utf-8", "replace") for x in batch.slice(first, last - first))
            coded = [np.array(encode_text(encoding, t), "<u4").tobytes() for t in texts]
            yield pa.array(coded, pa.binary())


def ids_of(text: Column, ranks: str, pattern: str) -> Column:
    """Token ids as little-endian unsigned 32-bit integers. Only texts go to Python."""

    @F.arrow_udf("binary")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _encoded(batches, load(ranks, pattern))

    return of(text.cast("binary"))


def bytes_of(ids: Column, ranks: str, pattern: str) -> Column:
    """The bytes that token ids stand for."""

    @F.arrow_udf("binary")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoding = load(ranks, pattern)
        for batch in batches:
            numbers = (np.frombuffer(x.as_py() or b"", "<u4").tolist() for x in batch)
            yield pa.array([encoding.decode_bytes(n) for n in numbers], pa.binary())

    return of(ids)


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``, the token ids as bytes."""
    return docs.drop(ids).withColumn(ids, ids_of(F.col(text), ranks, pattern))


def decode(coded: DataFrame, ranks: str, pattern: str, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """Add ``decoded``: the bytes that the ids stand for (null ids: none)."""
    return coded.drop(data).withColumn(data, bytes_of(F.col(ids), ranks, pattern))


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Number and hash of the ids and the hash of what they decode to, per document."""
    coded = decode(encode(docs.select("doc_id", "text"), ranks, pattern).drop("text"), ranks, pattern)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
