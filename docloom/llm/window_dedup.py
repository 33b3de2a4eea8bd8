"""Removal of repeated word windows with difference-cover anchors.

The word places of a document that are 0, 1, 4, 14 or 16 modulo 21 are its anchors.
These five numbers are a difference cover: any two places are, for some shift below 21,
both anchors when moved by it. So two equal windows of 35 words share an aligned pair
of anchors within their first 21 words, and the 15 words from each of the two on lie in
the windows and are equal, too. Hashing 15 words at the anchors alone, about a quarter
of all places, finds every long match; the match is then extended.

1. One narrow row per anchor, pre-aggregated by its hash, finds the anchors that occur
   again.
2. The surroundings of an anchor are the words of all windows that reach it from up to
   20 places before. Where all occurrences of an anchor have the same surroundings, all
   those windows are repeated; the same holds for each group of equal surroundings.
3. What is left is the rims of matches. There the windows of one place of each different
   surroundings are hashed as a whole and counted over all documents.

No step holds the rows of one hash together, so a passage that a third of all documents
share is aggregated map-side and joined in splittable pieces.

Definitions. Words are runs of anything but space and \\x09 to \\x0D. Null text has no
words, documents under 35 words lose nothing. Rows with equal id and equal text are the
same document: they don't repeat each other, and each range of theirs is collected once,
so that n of them take n times the room of one. Rows with equal id and other text are
different documents. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import rolling
from docloom.llm.common import doc_key, packed, packed_shares, stage, unpacked

#: Words in a window.
WINDOW = 35
#: Period and difference cover of the anchors.
PERIOD = 21
COVER = (0, 1, 4, 14, 16)
#: Words that are hashed at an anchor.
CORE = WINDOW - PERIOD + 1

_SHIFT = 32  # above the distance of an anchor from the start of a window

_ANCHOR = "core long, around long, doc long, at long, reach int"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = batch.column("doc").to_numpy()
        mark = batch.column("mark").to_numpy().astype(np.int64)
        for w in rolling.words(batch.column("data")):
            size = w.end - w.begin
            long = size >= WINDOW
            row, begin, size = w.row[long], w.begin[long], size[long]
            which = np.repeat(np.arange(len(row)), size - CORE + 1)
            place = rolling.ranges(np.zeros(len(row), np.int64), size - CORE + 1)
            first = np.maximum(place - PERIOD + 1, 0)
            last = np.minimum(place, size[which] - WINDOW)
            mine = np.isin(place % PERIOD, COVER) & (first <= last)
            which, place, first, last = which[mine], place[mine], first[mine], last[mine]
            at = begin[which] + place
            core = rolling.mix(rolling.Rolling(w.hashes, 0).between(at, at + CORE))
            reach = (place - first) * _SHIFT + (place - last)
            around = rolling.Rolling(w.hashes, 1).between(
                begin[which] + first, begin[which] + last + WINDOW
            )
            around = rolling.mix(around + reach.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(core.view(np.int64)),
                    pa.array(around.view(np.int64)),
                    pa.array(doc[row[which]]),
                    pa.array((mark[row[which]] << 32) | place),
                    pa.array(reach.astype(np.int32)),
                ],
                names=["core", "around", "doc", "at", "reach"],
            )


def _mark() -> Column:
    return F.shiftright("at", 32).cast("int").alias("mark")


def _place() -> Column:
    return F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")


def _apart() -> Column:
    """Whether a group has occurrences at several places; a repeated row adds none."""
    return ((F.min("doc") != F.max("doc")) | (F.min("at") != F.max("at"))).alias("apart")


def _starts(rows: DataFrame) -> DataFrame:
    """First and last start of the windows that reach an anchor."""
    return rows.select(
        "doc",
        _mark(),
        (_place() - F.floor(F.col("reach") / _SHIFT).cast("int")).alias("first"),
        (_place() - F.col("reach") % _SHIFT).alias("last"),
    )


_WINDOW_ROW = "low long, high long, doc long, at long"


def _open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows of the listed ranges."""
    for batch in packed_shares(batches):
        doc = batch.column("doc").to_numpy()
        mark = batch.column("mark").to_numpy().astype(np.int64)
        starts = batch.column("starts")
        for w in rolling.words(unpacked(batch)):
            low, high = rolling.Rolling(w.hashes, 0), rolling.Rolling(w.hashes, 1)
            rows, places, begins = [], [], []
            for row, begin, end in zip(w.row, w.begin, w.end):
                listed = starts[int(row)].values
                first = listed.field("first").to_numpy()
                last = listed.field("last").to_numpy()
                place = np.flatnonzero(_marked(end - begin, first, last))
                places.append(place)
                rows.append(np.full(len(place), row))
                begins.append(place + begin)
            row, place, at = (np.concatenate(x).astype(np.int64) for x in (rows, places, begins))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rolling.mix(low.between(at, at + WINDOW)).view(np.int64)),
                    pa.array(rolling.mix(high.between(at, at + WINDOW)).view(np.int64)),
                    pa.array(doc[row]),
                    pa.array((mark[row] << 32) | place),
                ],
                names=["low", "high", "doc", "at"],
            )


def _marked(size: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places that one of the closed ranges holds."""
    edges = np.zeros(size + 1, np.int32)
    np.add.at(edges, first, 1)
    np.add.at(edges, last + 1, -1)
    return np.cumsum(edges[:-1]) > 0


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("data")
    return docs.select(*doc_key(text), data)


def repeated_starts(keyed: DataFrame) -> DataFrame:
    """Ranges (doc, mark, first, last) of the starts of all windows that occur again."""
    anchors = keyed.mapInArrow(_anchors, _ANCHOR)
    # all minima, then all maxima: those of a single row are one repeat to the shuffle's
    # compression
    ends = ("doc", "at", "around")
    repeated = (
        anchors.groupBy("core")
        .agg(*[F.min(c).alias(f"{c}0") for c in ends], *[F.max(c).alias(f"{c}1") for c in ends])
        .where("doc0 <> doc1 or at0 <> at1")
        .selectExpr("core", "around0 <> around1 as several")
    )
    again = stage(anchors.join(repeated, "core"), "window_again")
    several = again.where("several")
    place = F.struct("doc", "at")
    shared = several.groupBy("core", "around").agg(F.min(place).alias("leader"), _apart())
    known = stage(
        several.join(shared, ["core", "around"])
        .withColumn("leads", place == F.col("leader"))
        .drop("leader"),
        "window_around",
    )
    settled = _starts(again.where("not several")).union(_starts(known.where("apart")))
    # different surroundings of one anchor: one place of each is compared window by window
    listed = (
        _starts(known.where("leads"))
        .groupBy("doc", "mark")
        .agg(F.collect_set(F.struct("first", "last")).alias("starts"))
    )
    windows = stage(
        packed(keyed).join(listed, ["doc", "mark"]).mapInArrow(_open_windows, _WINDOW_ROW), "window_open"
    )
    twice = windows.groupBy("low", "high").agg(_apart()).where("apart").drop("apart")
    found = windows.join(twice, ["low", "high"]).select(
        "doc", _mark(), _place().alias("first"), _place().alias("last")
    )
    return settled.union(found)


_CUT = "n_words long, n_removed long, kept binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in packed_shares(batches):
        texts = unpacked(batch)
        data, _ = rolling.buffers(texts)
        starts = batch.column("starts")
        total, removed, kept = [], [], []
        for w in rolling.words(texts):
            for row, begin, end in zip(w.row, w.begin, w.end):
                listed = starts[int(row)]
                left = np.arange(begin, end)
                if listed.is_valid:
                    gone = _marked(
                        end - begin,
                        listed.values.field("first").to_numpy(),
                        listed.values.field("last").to_numpy() + WINDOW - 1,
                    )
                    left = left[~gone]
                total.append(int(end - begin))
                removed.append(int(end - begin) - len(left))
                kept.append(_joined(data, w.start[left], w.stop[left]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array(total, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            names=["row", "n_words", "n_removed", "kept"],
        )


def _joined(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> bytes:
    """Words with one space between them."""
    if not len(start):
        return b""
    size = stop - start + 1
    places = rolling.ranges(start, size)
    places[-1] = start[-1]  # stands for the last space, which goes
    out = data[places]
    out[np.cumsum(size) - 1] = 0x20
    return out[:-1].tobytes()


def remove_windows(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace ``text`` by ``n_words``, ``n_removed`` and ``kept`` (binary) in every row.

    Columns of these names that ``docs`` has are replaced.
    """
    docs = docs.drop("n_words", "n_removed", "kept")
    starts = (
        repeated_starts(_keyed(docs, text))
        .groupBy("doc", "mark")
        .agg(F.collect_set(F.struct("first", "last")).alias("starts"))
    )
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("data")
    joined = (
        packed(docs.select(F.struct(*others).alias("row"), *doc_key(text), data))
        .join(starts, ["doc", "mark"], "left")
        .select("row", "data", "starts")
    )
    added = T.StructType.fromDDL(_CUT).fields
    return joined.mapInArrow(_cut, T.StructType([joined.schema["row"], *added])).select(
        "row.*", "n_words", "n_removed", "kept"
    )


def digests(docs: DataFrame) -> DataFrame:
    """Sizes and the hash of the words that are left, per document."""
    return remove_windows(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
