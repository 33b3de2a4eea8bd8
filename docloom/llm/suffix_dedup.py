"""Removal of repeated passages in corpus order, by prefix-free parsing.

Every document is parsed where a rolling hash triggers: of the 24-byte strings in a
passage of 100 bytes, the one with the smallest hash is the trigger, which depends on
the passage alone. The starts that share a trigger form a phrase; the phrase with the
100 bytes that follow its last start is a word of the dictionary. Equal passages have
equal triggers at equal distances, so the corpus order of two suffixes that agree in
100 bytes is settled among the dictionary words of one trigger: the suffixes of those
words are grouped by their distance to the trigger and a 64-bit hash of their first 100
bytes, and the first place of each word, a minimum over the parse, gives the first
occurrence of each group. This stands in for suffix arrays of dictionary and parse: only
whether suffixes agree in 100 bytes matters here, not which one sorts first.

What moves through the cluster follows from that:

1. one narrow row per phrase, pre-aggregated by trigger, finds the triggers that occur
   more than once;
2. of those, triggers with a single dictionary word are settled by their first place;
3. of the others each distinct word is fetched once, and the suffixes of the words of
   one trigger are sorted by these hashes. A trigger with more than ``HOT_WORDS`` different
   words has its suffixes hashed and aggregated over all tasks instead, so no task ever
   holds an unbounded group.

Definitions. Null text counts as empty, texts under 100 bytes lose nothing. Documents
are ordered by id, null first. Rows with equal id and equal text are the same document
and lose the same bytes; rows with equal id and other text are ordered by a hash of the
text. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import rolling
from docloom.llm.common import doc_key, packed, packed_shares, shares, stage, unpacked

#: Length in bytes of the passages that are compared.
PASSAGE = 100
#: Length in bytes of a trigger.
TRIGGER = 24
#: Words of a trigger beyond which they are compared over all tasks. Up to there one task
#: sorts their suffixes, at most 77 of each, in some tens of megabytes.
HOT_WORDS = 5000
#: Rows of the dictionary, and bytes of its words, that a task takes in at a time.
WORDS, WORD_BYTES = 1000, 1 << 20

_SHIFT = 128  # above the distance of a trigger from any start of its phrase

_PHRASE = "trigger long, word long, doc long, at long, reach int"
_SPAN = "doc long, mark int, start int, end int"


def _keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("data")
    return docs.select(*doc_key(text), data)


def _parse_round(r: rolling.Round) -> tuple[np.ndarray, ...]:
    """Phrases of a round: text, trigger, word, place of the trigger, first and last start."""
    triggers = rolling.mix(rolling.Rolling.of_bytes(r.data, 0).every(TRIGGER))
    best = rolling.sliding_argmin(triggers, PASSAGE - TRIGGER + 1)
    count = np.maximum(r.end - r.begin - PASSAGE + 1, 0)
    start = rolling.ranges(r.begin, count)
    text = np.repeat(np.arange(len(r.row)), count)
    if not len(start):
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    place = best[start]
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    s0, s1, place, text = start[first], start[last], place[first], text[first]
    mine = (place >= r.own_from) & (place < r.own_to)
    s0, s1, place, text = s0[mine], s1[mine], place[mine], text[mine]
    words = rolling.Rolling.of_bytes(r.data, 1).between(s0, s1 + PASSAGE)
    words = rolling.mix(words + ((place - s0) * _SHIFT + (place - s1)).astype(np.uint64))
    return text, triggers[place], words, place, s0, s1


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = batch.column("doc").to_numpy()
        mark = batch.column("mark").to_numpy().astype(np.int64)
        for r in rolling.rounds(batch.column("data"), 2 * PASSAGE):
            text, trigger, word, place, s0, s1 = _parse_round(r)
            row = r.row[text]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(trigger.view(np.int64)),
                    pa.array(word.view(np.int64)),
                    pa.array(doc[row]),
                    pa.array((mark[row] << 32) | (place + r.shift[text])),
                    pa.array(((place - s0) * _SHIFT + (place - s1)).astype(np.int32)),
                ],
                names=["trigger", "word", "doc", "at", "reach"],
            )


def phrases(keyed: DataFrame) -> DataFrame:
    """Parse of every document: (trigger, word, doc, at, reach).

    ``at`` holds the document's mark and the place of the trigger, ``reach`` how far
    the first and the last start of the phrase lie before it.
    """
    return keyed.mapInArrow(_phrases, _PHRASE)


def _place(at: str) -> tuple:
    at = F.col(at)
    return F.shiftright(at, 32).cast("int"), at.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")


def _spans(rows: DataFrame) -> DataFrame:
    """Bytes that the passages of whole phrases cover."""
    mark, place = _place("at")
    return rows.select(
        "doc",
        mark.alias("mark"),
        (place - F.floor(F.col("reach") / _SHIFT).cast("int")).alias("start"),
        (place - F.col("reach") % _SHIFT + PASSAGE).alias("end"),
    )


_WORD_ROW = "trigger long, hot boolean, doc long, mark int, place int, reach int, bytes binary"


def _fetch_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the phrases listed with each document."""
    for batch in packed_shares(batches):
        data, bounds = rolling.buffers(unpacked(batch))
        wanted = batch.column("wanted")
        row = np.repeat(np.arange(len(batch)), np.diff(wanted.offsets.to_numpy()))
        items = wanted.flatten()
        place = items.field("place").to_numpy().astype(np.int64)
        reach = items.field("reach").to_numpy().astype(np.int64)
        lo = bounds[row] + place - reach // _SHIFT
        size = bounds[row] + place - reach % _SHIFT + PASSAGE - lo
        doc, mark = batch.column("doc").to_numpy()[row], batch.column("mark").to_numpy()[row]
        for first, last in shares(size, WORD_BYTES):
            picked = data[rolling.ranges(lo[first:last], size[first:last])]
            offsets = np.concatenate([[0], np.cumsum(size[first:last])]).astype(np.int32)
            packed = pa.Array.from_buffers(
                pa.binary(), last - first, [None, pa.py_buffer(offsets), pa.py_buffer(picked.tobytes())]
            )
            some = items.slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [
                    some.field("trigger"),
                    some.field("hot"),
                    pa.array(doc[first:last]),
                    pa.array(mark[first:last]),
                    some.field("place"),
                    some.field("reach"),
                    packed,
                ],
                names=["trigger", "hot", "doc", "mark", "place", "reach", "bytes"],
            )


def _suffixes(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """All suffixes of dictionary words that hold a passage: the row of the word, the
    distance before the trigger, the passage's hash."""
    data, bounds = rolling.buffers(batch.column("bytes"))
    data = data[bounds[0] : bounds[-1]]
    begin = bounds[:-1] - bounds[0]
    count = np.diff(bounds) - PASSAGE + 1
    start = rolling.ranges(begin, count)
    row = np.repeat(np.arange(len(batch)), count)
    reach = batch.column("reach").to_numpy().astype(np.int64)
    before = (begin + reach // _SHIFT)[row] - start
    hashes = rolling.Rolling.of_bytes(data, 1).between(start, start + PASSAGE)
    return row, before, rolling.mix(hashes)


def _runs(doc, mark, start, end) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc, pa.int64()),
            pa.array(mark, pa.int32()),
            pa.array(start, pa.int32()),
            pa.array(end, pa.int32()),
        ],
        names=["doc", "mark", "start", "end"],
    )


def _later_suffixes(group: pa.RecordBatch) -> pa.RecordBatch:
    """Passages of complete triggers that start earlier in the corpus, too."""
    row, before, hashes = _suffixes(group)
    trigger = group.column("trigger").to_numpy()
    doc = group.column("doc").to_numpy()
    mark = group.column("mark").to_numpy()
    place = group.column("place").to_numpy().astype(np.int64)
    # rank of each word's place in the corpus; a repeated row has the same place
    by_place = np.lexsort((place, mark, doc))
    d, m, p = doc[by_place], mark[by_place], place[by_place]
    other = np.ones(len(group), bool)
    other[1:] = (d[1:] != d[:-1]) | (m[1:] != m[:-1]) | (p[1:] != p[:-1])
    corpus = np.empty(len(group), np.int64)
    corpus[by_place] = np.cumsum(other)
    order = np.lexsort((corpus[row], hashes, before, trigger[row]))
    r, b, h = row[order], before[order], hashes[order]
    t = trigger[r]
    leads = np.ones(len(r), bool)
    leads[1:] = (t[1:] != t[:-1]) | (b[1:] != b[:-1]) | (h[1:] != h[:-1])
    earliest = corpus[r[np.maximum.accumulate(np.where(leads, np.arange(len(r)), 0))]]
    later = corpus[r] != earliest
    r, start = r[later], place[r[later]] - b[later]
    order = np.lexsort((start, r))
    r, start = r[order], start[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(r))[: len(first)] - 1
    r = r[first]
    return _runs(doc[r], mark[r], start[first], start[last] + PASSAGE)


def _sort_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive by trigger; a trigger that a batch may cut waits for the next one.

    A trigger has at most ``HOT_WORDS`` rows here, so what waits is bounded.
    """
    rest: pa.Table | None = None
    for batch in batches:
        for part in (batch.slice(i, WORDS) for i in range(0, len(batch), WORDS)):
            table = pa.Table.from_batches([part])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            table = table.combine_chunks()
            trigger = table.column("trigger").to_numpy()
            cut = int(np.searchsorted(trigger, trigger[-1], "left")) if len(trigger) else 0
            rest = table.slice(cut)
            if cut:
                yield _later_suffixes(table.slice(0, cut).to_batches()[0])
    if rest is not None and len(rest):
        yield _later_suffixes(rest.combine_chunks().to_batches()[0])


_SUFFIX = "trigger long, before int, passage long, doc long, at long"


def _spread_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(i, WORDS) for i in range(0, len(batch), WORDS)):
            row, before, hashes = _suffixes(part)
            place = part.column("place").to_numpy().astype(np.int64)[row] - before
            mark = part.column("mark").to_numpy().astype(np.int64)[row]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part.column("trigger").to_numpy()[row]),
                    pa.array(before, pa.int32()),
                    pa.array(hashes.view(np.int64)),
                    pa.array(part.column("doc").to_numpy()[row]),
                    pa.array((mark << 32) | place),
                ],
                names=["trigger", "before", "passage", "doc", "at"],
            )


def repeated_spans(keyed: DataFrame, hot_words: int = HOT_WORDS) -> DataFrame:
    """Stretches (doc, mark, start, end) of all passages that also start earlier.

    Stretches may overlap; together they are exactly the bytes to remove.
    """
    parse = phrases(keyed)
    place = F.struct("doc", "at")
    repeated = (
        parse.groupBy("trigger")
        .agg(
            F.min(place).alias("first"),
            F.count(F.lit(1)).alias("times"),
            F.min("word").alias("word0"),
            F.max("word").alias("word1"),
        )
        .where("times > 1")
        .select(
            "trigger",
            "first",
            (F.col("word0") != F.col("word1")).alias("several"),
        )
    )
    again = stage(
        parse.join(repeated, "trigger")
        .where(F.col("several") | (place != F.col("first")))
        .drop("first"),
        "suffix_again",
    )
    # triggers with one dictionary word: all places but the first
    settled = _spans(again.where("not several"))
    # several words: every word settles its own later places
    several = again.where("several")
    firsts = several.groupBy("trigger", "word").agg(F.min(place).alias("first"))
    known = stage(
        several.join(firsts, ["trigger", "word"])
        .select("trigger", "doc", "at", "reach", (place == F.col("first")).alias("leads")),
        "suffix_words",
    )
    mark, spot = _place("at")
    leads = known.where("leads")
    hot = (
        leads.groupBy("trigger")
        .agg(F.count(F.lit(1)).alias("words"))
        .where(F.col("words") > hot_words)
        .select("trigger", F.lit(True).alias("many"))
    )
    wanted = (
        leads.join(hot, "trigger", "left")
        .withColumn("hot", F.coalesce("many", F.lit(False)))
        .groupBy("doc", mark.alias("mark"))
        .agg(
            F.collect_set(F.struct("trigger", "hot", spot.alias("place"), "reach")).alias("wanted")
        )
    )
    words = stage(
        packed(keyed).join(wanted, ["doc", "mark"]).mapInArrow(_fetch_words, _WORD_ROW),
        "suffix_dictionary",
    )
    sorted_words = (
        words.where("not hot")
        .repartition("trigger")
        .sortWithinPartitions("trigger")
        .mapInArrow(_sort_words, _SPAN)
    )
    suffixes = words.where("hot").mapInArrow(_spread_words, _SUFFIX)
    keys = ["trigger", "before", "passage"]
    earliest = (
        suffixes.groupBy(*keys)
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
        .where("times > 1")
        .drop("times")
    )
    spread = (
        suffixes.join(earliest, keys)
        .where(place != F.col("first"))
        .select("doc", mark.alias("mark"), spot.alias("start"), (spot + PASSAGE).alias("end"))
    )
    return settled.union(_spans(known.where("not leads"))).union(sorted_words).union(spread)


_CUT = "n_removed long, n_spans long, kept binary"


def _cutter(whole_characters: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in packed_shares(batches):
            data, bounds = rolling.buffers(unpacked(batch))
            spans = batch.column("spans")
            removed, pieces, kept = [], [], []
            for i in range(len(batch)):
                text, span = data[bounds[i] : bounds[i + 1]], spans[i]
                gone = np.zeros(len(text), bool)
                if span.is_valid and len(text):
                    edges = np.zeros(len(text) + 1, np.int32)
                    np.add.at(edges, span.values.field("start").to_numpy(), 1)
                    np.add.at(edges, span.values.field("end").to_numpy(), -1)
                    gone = np.cumsum(edges[:-1]) > 0
                removed.append(int(gone.sum()))
                pieces.append(int((np.diff(gone.astype(np.int8), prepend=0) > 0).sum()))
                left = text[~gone].tobytes()
                if whole_characters and removed[-1]:
                    left = left.decode("utf-8", "ignore").encode()
                kept.append(left)
            columns = [pa.array(removed, pa.int64()), pa.array(pieces, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *columns], names=["row", "n_removed", "n_spans", "kept"]
            )

    return cut


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    hot_words: int = HOT_WORDS,
    whole_characters: bool = False,
) -> DataFrame:
    """Replace ``text`` by ``n_removed``, ``n_spans`` and ``kept`` (binary) in every row.

    Columns of these names that ``docs`` has are replaced. Passages are cut at byte
    level; ``whole_characters`` also drops the rest of a character that a cut divides.
    """
    docs = docs.drop("n_removed", "n_spans", "kept")
    keyed = _keyed(docs, text)
    spans = (
        repeated_spans(keyed, hot_words)
        .groupBy("doc", "mark")
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("data")
    joined = (
        packed(docs.select(F.struct(*others).alias("row"), *doc_key(text), data))
        .join(spans, ["doc", "mark"], "left")
        .select("row", "data", "spans")
    )
    added = T.StructType.fromDDL(_CUT).fields
    cut = joined.mapInArrow(_cutter(whole_characters), T.StructType([joined.schema["row"], *added]))
    return cut.select("row.*", "n_removed", "n_spans", "kept")


def digests(docs: DataFrame) -> DataFrame:
    """Sizes and the hash of what is left, per document."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return remove_repeats(docs.select("doc_id", size, "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without their repeated passages; ``n_chars`` is counted anew.

    A null text stays null.
    """
    # the columns travel as one value, so that none meets one of the operator
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("others")
    is_null = F.col("text").isNull().alias("is_null")
    cut = remove_repeats(docs.select("doc_id", "text", is_null, others), whole_characters=True)
    text = F.when(~F.col("is_null"), F.col("kept").cast("string"))
    new = {"text": text, "n_chars": F.when(~F.col("is_null"), F.length(text)).cast("long")}
    return cut.select(
        *[new[c].alias(c) if c in new else F.col("others").getField(c).alias(c) for c in docs.columns]
    )
