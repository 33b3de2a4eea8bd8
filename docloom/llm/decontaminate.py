"""Benchmark passages in documents, found by Wu-Manber multi-pattern search over words.

The patterns are the windows of ten words of the benchmark items; an item of fewer words
is one shorter window. The search looks at the last word of where a window could end:

1. A shift table tells, for every block of the last three words (fewer for shorter
   windows), how many words to go on until it could be the end of a window. A block that
   no window holds is passed by with a step of nearly a window, so most words of a clean
   text are never looked at. The table has one byte per hash of a block; blocks that
   share a hash share the smaller step.
2. Where the step is 0, the bucket of that hash of the last words holds the windows that
   end like this.
3. One of them is reported if its words are those of the text, compared directly.

Windows of different lengths have tables of their own, so that a short item doesn't
shorten the steps of the others.

The items are cut into slices of bounded size. While all of them together are no larger
than ``TABLE_BYTES``, they travel to the tasks as one table and the documents are read
once. A larger benchmark goes in blocks of that size, each with a read of the documents;
what a block finds is kept for the documents with hits only, and put together by document.

Definitions. Words are those of ``byte_words``; null and empty texts have none. Items
without words have no window. Items that share an id count as one; an item without an
id counts as one, whose name is the empty text. Documents of one id and one text have the
same hits; documents of one id and several texts are different. A window must lie in one
document and in one item. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial, reduce

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import byte_words
from docloom.llm.common import doc_key, stage

#: Words in a window.
WINDOW = 10
#: Words in a block of the shift table.
BLOCK = 3
#: Bits of a block's hash: the table has a byte for each.
HASH_BITS = 20
#: Words of an item that travel as one row.
SLICE_WORDS = 4096
#: Bytes of items in one table, which takes some 60 times that room in a task.
TABLE_BYTES = 4 << 20

_MASK = (1 << HASH_BITS) - 1


class Table:
    """Shift table and buckets of all windows of one length."""

    def __init__(self, length: int) -> None:
        self.length, self.block = length, min(BLOCK, length)
        self.shift = bytearray([length - self.block + 1]) * (1 << HASH_BITS)
        self.buckets: dict[int, dict[bytes, list[int]]] = {}

    def add(self, words: list[bytes], item: int) -> None:
        """Take in the windows of an item's words."""
        length, block, shift = self.length, self.block, self.shift
        hashes = [hash(tuple(words[i : i + block])) & _MASK for i in range(len(words) - block + 1)]
        for begin in range(len(words) - length + 1):
            for step in range(length - block + 1):
                # the block that ends ``step`` words before the window does
                h = hashes[begin + length - block - step]
                if shift[h] > step:
                    shift[h] = step
            bucket = self.buckets.setdefault(hashes[begin + length - block], {})
            items = bucket.setdefault(b" ".join(words[begin : begin + length]), [])
            if not items or items[-1] != item:
                items.append(item)

    def occurrences(self, words: list[bytes], first: int) -> Iterator[tuple[int, list[int]]]:
        """(end, items) of the windows in ``words`` that end at a place from ``first`` on."""
        length, block, shift, buckets = self.length, self.block, self.shift, self.buckets
        end, last = max(length, first + 1), len(words)
        while end <= last:
            h = hash(tuple(words[end - block : end])) & _MASK
            step = shift[h]
            if step:
                end += step
                continue
            items = buckets[h].get(b" ".join(words[end - length : end]))
            if items:
                yield end, items
            end += 1


class Patterns:
    """Tables of all lengths of windows of some slices of items."""

    def __init__(self, slices: list[tuple[str, bytes]]) -> None:
        self.tables: dict[int, Table] = {}
        self.items: list[str] = []
        numbers: dict[str, int] = {}
        # windows of one item follow each other, for ``Table.add``
        for item, text in sorted(slices):
            if item not in numbers:
                numbers[item] = len(self.items)
                self.items.append(item)
            words = text.split(b" ")
            length = min(WINDOW, len(words))
            if length not in self.tables:
                self.tables[length] = Table(length)
            self.tables[length].add(words, numbers[item])

    def search(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, hit ranges of words in order and apart, and the items hit."""
        n_words, ranges, hit = 0, [], set()
        for words, carried in byte_words.slices(text, WINDOW - 1):
            at = n_words - carried  # place of the first word of this slice
            n_words = at + len(words)
            for length, table in self.tables.items():
                for end, items in table.occurrences(words, carried):
                    ranges.append((at + end - length, at + end))
                    hit.update(items)
        return n_words, _union(ranges), [self.items[i] for i in hit]


def _union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column("item").to_pylist(), batch.column("data")):
            for words, _ in byte_words.slices(text.as_py(), WINDOW - 1):
                begins = range(0, max(1, len(words) - WINDOW + 1), SLICE_WORDS)
                parts = [b" ".join(words[i : i + SLICE_WORDS + WINDOW - 1]) for i in begins]
                yield pa.RecordBatch.from_pydict(
                    {"item": pa.array([item] * len(parts), pa.string()), "part": pa.array(parts, pa.binary())}
                )


def item_slices(items: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(item, part): the distinct slices of the items' words, which hold all their windows."""
    named = F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item")
    given = items.select(named, F.col(f"`{text}`").cast("binary").alias("data"))
    return given.mapInArrow(_sliced, "item string, part binary").distinct()


#: The tables that this Python worker built last, by the name of the search.
_BUILT: dict[str, Patterns] = {}


def _patterns(name: str, shared: Broadcast) -> Patterns:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Patterns(shared.value)
    return _BUILT[name]


_FOUND = "n_words long, spans array<struct<start: long, stop: long>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _search(
    batches: Iterator[pa.RecordBatch], name: str, shared: Broadcast, hits_only: bool
) -> Iterator[pa.RecordBatch]:
    patterns = _patterns(name, shared)
    for batch in batches:
        found = [patterns.search(text.as_py()) for text in batch.column("data")]
        rows = [i for i, x in enumerate(found) if x[1] or not hits_only]
        found = [found[i] for i in rows]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c).take(pa.array(rows, pa.int64())) for c in batch.schema.names[:-1]),
                pa.array([x[0] for x in found], pa.int64()),
                pa.array([[{"start": a, "stop": b} for a, b in x[1]] for x in found], _SPANS),
                pa.array([x[2] for x in found], pa.list_(pa.string())),
            ],
            names=[*batch.schema.names[:-1], "n_words", "spans", "items"],
        )


def _searched(given: DataFrame, slices: DataFrame, hits_only: bool) -> DataFrame:
    """Add what is found to ``given``, whose last column is the text."""
    parts = [(r.item, bytes(r.part)) for r in slices.collect()]
    shared = given.sparkSession.sparkContext.broadcast(parts)
    schema = T.StructType(given.schema.fields[:-1] + T.StructType.fromDDL(_FOUND).fields)
    run = partial(_search, name=uuid.uuid4().hex, shared=shared, hits_only=hits_only)
    return given.mapInArrow(run, schema)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Put together what several blocks of items found in one document."""
    for batch in batches:
        spans, items = [], []
        for row in batch.select(["spans", "items"]).to_pylist():
            ranges = [(x["start"], x["stop"]) for block in row["spans"] or [] for x in block]
            spans.append([{"start": a, "stop": b} for a, b in _union(ranges)])
            items.append(sorted({x for block in row["items"] or [] for x in block}))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("n_words"), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))],
            names=["row", "n_words", "spans", "items"],
        )


def _n_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [
            sum(len(words) - carried for words, carried in byte_words.slices(text.as_py(), 0))
            for text in batch.column("data")
        ]
        yield batch.drop_columns(["data"]).append_column("n_words", pa.array(n, pa.int64()))


def hits(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """(row, n_words, spans, items) per document: ``row`` holds its columns but the text,
    ``spans`` the ranges of words that windows cover, ``items`` the names of their items."""
    slices = stage(item_slices(items, text, item_id), "item_slices")
    size = slices.agg(F.sum(F.octet_length("part") + F.octet_length("item"))).first()[0] or 0
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row")
    data = F.col(f"`{text}`").cast("binary").alias("data")
    if size <= table_bytes:
        return _searched(docs.select(row, data), slices, False)
    # a hash deals the slices out evenly: twice as many blocks as need be, for its deviations
    blocks = 2 * -(-size // table_bytes)
    block = F.pmod(F.xxhash64("item", "part"), F.lit(blocks))
    # hits are those of a text, whoever has it
    key = F.md5(F.col(f"`{text}`").cast("binary")).alias("key")
    found = [
        stage(_searched(docs.select(key, data), slices.where(block == b), True), "item_hits")
        for b in range(blocks)
    ]
    merged = (
        reduce(DataFrame.union, [f.dropDuplicates(["key"]) for f in found])
        .groupBy("key")
        .agg(F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    )
    given = docs.select(row, key, data)
    counted = T.StructType([*given.schema.fields[:-1], T.StructField("n_words", T.LongType())])
    joined = given.mapInArrow(_n_words, counted).join(merged, "key", "left")
    out = T.StructType([joined.schema["row"], *T.StructType.fromDDL(_FOUND).fields])
    return joined.select("row", "n_words", "spans", "items").mapInArrow(_merge, out)


def without_contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    found = hits(docs.select(whole, F.col(f"`{text}`").alias("text")), items.withColumnRenamed(text, "text"), "text", item_id)
    return found.where(F.size("spans") == 0).select("row.whole.*")


def digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Numbers of words, of hit words and of items, and the items' hash, per document."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    return hits(docs.select("doc_id", "text"), items).select(
        "row.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
