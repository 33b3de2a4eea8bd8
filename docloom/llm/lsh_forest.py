"""Near-duplicate documents with an LSH forest.

Documents of one and the same set of five-word shingles form a class at once, told by a
128-bit hash of the set; one of each class, the one of the smallest id, goes on. Its
128 minhashes are the labels of 16 trees of 8 levels. Sorting the classes by their labels in a
tree puts those with a long common prefix side by side, so each tree is a sorted order,
range-partitioned over the cluster.

Candidates are neighbours in these orders. Where few classes share a prefix of
``MIN_DEPTH`` levels, all of them are candidates of each other. Where more than
``REGION`` share it, the region is divided by the next level, and so on down to
``MAX_DEPTH``; neighbours in the order are candidates in any case, so that a large group
of near copies is chained through every tree. Candidates whose sizes or two-bit sketches
rule a link out are dropped (a link would have to be off by four standard deviations).

Links are confirmed on the full sets, in rounds, and a round leaves out pairs that
earlier links have connected: first each document and its candidate of the smallest id;
then the other candidates; then, in each region that had to be divided, every document
and ``HUBS`` of its documents whose sketches are the most common ones, which is the
quick way for large groups of copies of one text. The last round is exact: the documents of
divided regions that are still apart are joined on the rarest shingles of their sets. With
all shingles in one order, two linked sets share one of the first 15 per cent of each, and
the places of the first one shared leave room for the overlap. Joining shares of a
shingle's documents keeps common shingles from being hot keys, and documents that the
rounds before have connected are not joined with each other.

Two documents of similarity 0.85 share a region of at least four levels in none of the
16 trees with probability 0.00001.

Definitions. A-Z is lower-cased, words are runs of anything but space and \\x09 to \\x0D;
fewer than five words are one shingle; without words (or with null text) a document is
linked with nothing. Rows without an id are ordered last; a component that has no other
rows gets null. Rows of one id are one document, which is linked if any of them is.
Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm import rolling
from docloom.llm.common import packed, stage, unpacked
from docloom.llm.components import components

#: Words in a shingle.
SHINGLE = 5
#: Per cent of the union that the intersection has to reach.
PERCENT = 85
#: Sorted orders and the minhashes that each of them sorts by.
TREES, LEVELS = 16, 8
#: Levels that candidates share at least, and to which regions are divided; beyond a
#: tree's own levels come those of the next tree.
MIN_DEPTH, MAX_DEPTH = 4, 16
#: Classes of a region that are all compared with each other.
REGION = 32
#: Central documents of a divided region with which all of it is compared.
HUBS = 4
#: Of 128 two-bit minhashes, those that linked sets share at least; 113.6 are expected.
SKETCH_MATCHES = 99
#: Counters of shingles, by which they are ordered: any order is right, rare first is quick.
COUNTERS = 1 << 18
#: Ids of candidates that are broadcast at most, to pick their texts without moving any.
BROADCAST_IDS = 1 << 21
#: Documents of a shingle that one task joins with all of its documents.
SHARE = 1024

_LAST_ID = 2**63 - 1
_HASHES = TREES * LEVELS
_RNG = np.random.default_rng(20240923)
_FACTORS = _RNG.integers(1, 1 << 63, _HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RNG.integers(1, 1 << 63, _HASHES, dtype=np.uint64)


def _lowered(column: pa.Array) -> pa.Array:
    data, bounds = rolling.buffers(column)
    base = int(bounds[0])
    text = data[base : int(bounds[-1])]
    text = text | ((text - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5)
    offsets = (bounds - base).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(column), [None, pa.py_buffer(offsets), pa.py_buffer(text)]
    )


def _sets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows with their distinct shingles' hashes, end to end and sorted, and their sizes."""
    for w in rolling.words(_lowered(column)):
        size = w.end - w.begin
        count = np.where(size >= SHINGLE, size - SHINGLE + 1, np.minimum(size, 1))
        which = np.repeat(np.arange(len(size)), count)
        start = rolling.ranges(w.begin, count)
        end = start + np.minimum(size, SHINGLE)[which]
        hashes = rolling.mix(rolling.Rolling(w.hashes, 0).between(start, end))
        order = np.lexsort((hashes, which))
        hashes, which = hashes[order], which[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (which[1:] != which[:-1])
        yield w.row, hashes[new], np.bincount(which[new], minlength=len(size))


_SIGNED = "doc long, n_shingles long, set_low long, set_high long, labels binary"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = batch.column("doc").to_numpy()
        for row, hashes, size in _sets(batch.column("data")):
            full = size > 0
            begin = (np.cumsum(size) - size)[full]
            low, high = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
            labels = np.zeros((len(size), _HASHES), ">u4")
            if len(begin):
                low[full] = np.add.reduceat(rolling.mix(hashes), begin)
                high[full] = np.add.reduceat(rolling.mix(hashes ^ np.uint64(0xD6E8FEB86659FD93)), begin)
                for i in range(_HASHES):
                    spread = (hashes * _FACTORS[i] + _OFFSETS[i]) >> np.uint64(32)
                    labels[full, i] = np.minimum.reduceat(spread, begin)
            flat = labels.tobytes()
            width = 4 * _HASHES
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[row]),
                    pa.array(size.astype(np.int64)),
                    pa.array(low.view(np.int64)),
                    pa.array(high.view(np.int64)),
                    pa.array([flat[i * width : (i + 1) * width] for i in range(len(size))], pa.binary()),
                ],
                names=["doc", "n_shingles", "set_low", "set_high", "labels"],
            )


_TREE_ROW = "tree int, path binary, sketch binary, doc long, n_shingles long"


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = rolling.buffers(batch.column("labels"))
        labels = data[int(bounds[0]) : int(bounds[-1])].reshape(len(batch), TREES, 4 * LEVELS)
        # two bits of each minhash, mixed, as minima have small values
        values = labels.reshape(len(batch), _HASHES, 4).copy().view(">u4")[:, :, 0].astype(np.uint64)
        mixed = rolling.mix(values)
        bits = [((mixed >> np.uint64(i)) & np.uint64(1)).astype(np.uint8) for i in range(2)]
        packed_bits = np.concatenate([np.packbits(b, axis=1) for b in bits], axis=1)
        sketch = pa.array([b.tobytes() for b in packed_bits], pa.binary())
        for tree in range(TREES):
            both = np.concatenate([labels[:, tree], labels[:, (tree + 1) % TREES]], axis=1)
            path = [p.tobytes() for p in both]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(batch), tree, np.int32)),
                    pa.array(path, pa.binary()),
                    sketch,
                    batch.column("doc"),
                    batch.column("n_shingles"),
                ],
                names=["tree", "path", "sketch", "doc", "n_shingles"],
            )


def _near(sketch: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two sketches share enough of their two-bit minhashes."""
    half = sketch.shape[1] // 2
    differ = sketch[a] ^ sketch[b]
    differ = differ[:, :half] | differ[:, half:]
    return np.bitwise_count(differ).sum(axis=1) <= _HASHES - SKETCH_MATCHES


def _neighbours(table: pa.Table) -> tuple[pa.RecordBatch, int]:
    """Candidates among sorted rows, and how many of the last rows may have more to come.

    A pair has its two rows in ``a`` and ``b``; a row of a divided region is in ``a``,
    with the region and how far its sketch is from the most common one there.
    """
    rows = table.num_rows

    def matrix(name: str, width: int) -> np.ndarray:
        data, bounds = rolling.buffers(table.column(name).combine_chunks())
        return data[int(bounds[0]) : int(bounds[-1])].reshape(rows, width)

    tree = table.column("tree").to_numpy()
    path = matrix("path", 4 * MAX_DEPTH).copy().view(np.uint32)
    sketch = matrix("sketch", _HASHES // 4).copy().view(np.uint64)
    doc, size = table.column("doc").to_numpy(), table.column("n_shingles").to_numpy()
    same = (path[1:] == path[:-1]) & (tree[1:] == tree[:-1])[:, None]
    # levels shared with the row before
    shared = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    region = np.full(rows, -1)
    placed = np.zeros(rows, bool)
    for depth in range(MIN_DEPTH, MAX_DEPTH + 1):
        first = np.flatnonzero(np.append(True, shared < depth))
        count = np.diff(np.append(first, rows))
        small = np.repeat(count <= REGION, count) & ~placed
        # a place of its own for the regions of each depth
        region[small] = (np.repeat(first, count) * (MAX_DEPTH + 1) + depth)[small]
        if depth == MIN_DEPTH:
            divided = np.flatnonzero(~small)
        placed |= small
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for apart in range(1, min(REGION, rows)):
        together = (region[apart:] == region[:-apart]) & (region[apart:] >= 0)
        if apart == 1:
            together |= shared >= MIN_DEPTH
        at = np.flatnonzero(together)
        left.append(at)
        right.append(at + apart)
    a, b = np.concatenate(left), np.concatenate(right)
    fits = 100 * np.minimum(size[a], size[b]) >= PERCENT * np.maximum(size[a], size[b])
    a, b = a[fits], b[fits]
    near = _near(sketch, a, b) & (doc[a] != doc[b])
    a, b = doc[a[near]], doc[b[near]]
    names = rolling.mix(
        path[:, :MIN_DEPTH].copy().view(np.uint64)[:, 0]
        ^ rolling.mix(path[:, :MIN_DEPTH].copy().view(np.uint64)[:, 1] + tree.astype(np.uint64))
    ).view(np.int64)[divided]
    none = pa.nulls(len(divided), pa.int64())
    distance = np.zeros(len(divided), np.int32)
    bits = np.unpackbits(sketch[divided].view(np.uint8), axis=1)
    starts = np.flatnonzero(np.append(True, names[1:] != names[:-1])) if len(names) else names
    for lo, hi in zip(starts, np.append(starts[1:], len(names))):
        differ = bits[lo:hi] != (bits[lo:hi].mean(axis=0) > 0.5)
        distance[lo:hi] = (differ[:, :_HASHES] | differ[:, _HASHES:]).sum(axis=1)
    found = pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([pa.array(np.minimum(a, b)), pa.array(doc[divided])]),
            pa.concat_arrays([pa.array(np.maximum(a, b)), none]),
            pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(names)]),
            pa.concat_arrays([pa.nulls(len(a), pa.int32()), pa.array(distance)]),
        ],
        names=["a", "b", "region", "distance"],
    )
    ended = np.flatnonzero(shared < MIN_DEPTH)
    open_rows = rows - (int(ended[-1]) + 1 if len(ended) else 0)
    return found, min(open_rows, REGION)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of the trees in, pairs out; the last rows of a batch wait for the next."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        found, waiting = _neighbours(table)
        rest = table.slice(table.num_rows - waiting)
        yield found


def _data(batch: pa.RecordBatch) -> pa.Array:
    return batch.column("data")


def _shingle_sets(
    batches: Iterator[pa.RecordBatch], data: Callable[[pa.RecordBatch], pa.Array]
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = batch.column("doc").to_numpy()
        for row, hashes, size in _sets(data(batch)):
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[row]), pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64)))],
                names=["doc", "shingles"],
            )


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are linked by their full sets."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(100 * both >= PERCENT * (F.size("left") + F.size("right") - both))
        .select("a", "b")
    )


def _apart(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs that the links don't connect."""
    known = components(links)
    side_a = known.select(F.col("node").alias("a"), F.col("component").alias("of_a"))
    side_b = known.select(F.col("node").alias("b"), F.col("component").alias("of_b"))
    return (
        pairs.join(side_a, "a", "left")
        .join(side_b, "b", "left")
        .where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))
        .select("a", "b")
    )


_PREFIX_ROW = "doc long, shingle long, place int, n int"


def _prefixes(counts: np.ndarray):
    """The first shingles of each set, rare ones first, of which linked sets share one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("shingles")
            values, bounds = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            size = np.diff(bounds)
            which = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((values, counts[values & (COUNTERS - 1)], which))
            place = rolling.ranges(np.zeros(len(size), np.int64), size)
            first = place < (size - (PERCENT * size + 99) // 100 + 1)[which]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column("doc").to_numpy()[which[first]]),
                    pa.array(values[order][first]),
                    pa.array(place[first].astype(np.int32)),
                    pa.array(size[which[first]].astype(np.int32)),
                ],
                names=["doc", "shingle", "place", "n"],
            )

    return cut


def _prefix_pairs(sets: DataFrame, links: DataFrame) -> DataFrame:
    """Every pair of sets that may be linked and that the links don't connect."""
    counter = F.col("shingle").bitwiseAND(F.lit(COUNTERS - 1))
    found = (
        sets.select(F.explode("shingles").alias("shingle"))
        .groupBy(counter.alias("counter"))
        .agg(F.count(F.lit(1)).alias("n"))
        .toArrow()
    )
    counts = np.zeros(COUNTERS, np.int64)
    counts[found.column("counter").to_numpy()] = found.column("n").to_numpy()
    known = components(links).select(F.col("node").alias("doc"), "component")
    rows = stage(
        sets.mapInArrow(_prefixes(counts), _PREFIX_ROW)
        .join(known, "doc", "left")
        .withColumn("component", F.coalesce("component", "doc")),
        "forest_prefixes",
    )
    # the largest component of a shingle's documents isn't joined with itself
    holders = (
        rows.groupBy("shingle", "component")
        .agg(F.count(F.lit(1)).alias("docs"))
        .groupBy("shingle")
        .agg(F.max(F.struct("docs", "component")).alias("most"), F.sum("docs").alias("docs"))
        .where("docs > most.docs")
        .select(
            "shingle",
            F.col("most.component").alias("main"),
            F.ceil((F.col("docs") - F.col("most.docs")) / SHARE).alias("shares"),
        )
    )
    shared = stage(rows.join(holders, "shingle"), "forest_shared")
    left = shared.where("component <> main").withColumn("share", F.pmod(F.xxhash64("doc"), F.col("shares")))
    right = shared.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
    l, r = left.alias("l"), right.hint("merge").alias("r")
    least, most = F.least("l.n", "r.n"), F.greatest("l.n", "r.n")
    # what the sets can share from here on
    room = F.least(F.col("l.n") - F.col("l.place"), F.col("r.n") - F.col("r.place"))
    fits = (
        (F.col("l.shingle") == F.col("r.shingle"))
        & (F.col("l.share") == F.col("r.share"))
        & (F.col("l.component") != F.col("r.component"))
        & ((F.col("r.component") == F.col("r.main")) | (F.col("l.doc") < F.col("r.doc")))
        & (100 * least >= PERCENT * most)
        & ((100 + PERCENT) * room >= PERCENT * (least + most))
    )
    return l.join(r, fits).select(
        F.least("l.doc", "r.doc").alias("a"), F.greatest("l.doc", "r.doc").alias("b")
    ).distinct()


def _links(keyed: DataFrame, classes: DataFrame) -> DataFrame:
    """Enough confirmed links between classes to connect what is connected."""
    trees = classes.mapInArrow(_tree_rows, _TREE_ROW)
    partitions = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stage(
        trees.repartitionByRange(partitions, "tree", "path")
        .sortWithinPartitions("tree", "path")
        .mapInArrow(_candidates, "a long, b long, region long, distance int")
        .distinct(),
        "forest_candidates",
    )
    pairs = found.where("region is null").select("a", "b")
    divided = found.where("region is not null").select(F.col("a").alias("doc"), "region", "distance")
    members = stage(
        found.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct(), "forest_members"
    )
    if members.count() <= BROADCAST_IDS:
        # the texts stay where they are
        texts, data = keyed.join(F.broadcast(members), "doc", "left_semi"), _data
    else:
        texts, data = packed(keyed).join(members, "doc", "left_semi"), unpacked
    sets = stage(
        texts.mapInArrow(partial(_shingle_sets, data=data), "doc long, shingles array<long>"), "forest_sets"
    )
    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = stage(_confirmed(first, sets), "forest_links")
    others = _apart(pairs.join(first, ["a", "b"], "left_anti"), links)
    links = links.union(stage(_confirmed(others, sets), "forest_links"))
    # pre-aggregated, and one row of each share, so that a large region is no hot key
    share = F.pmod(F.xxhash64("doc"), F.lit(HUBS))
    hubs = (
        divided.groupBy("region", share.alias("share"))
        .agg(F.min(F.struct("distance", "doc")).alias("hub"))
        .select("region", F.col("hub.doc").alias("hub"))
    )
    to_hubs = (
        divided.join(hubs, "region")
        .select(F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b"))
        .where("a <> b")
        .distinct()
    )
    links = links.union(stage(_confirmed(_apart(to_hubs, links), sets), "forest_links"))
    inside = sets.join(divided.select("doc").distinct(), "doc", "left_semi")
    return links.union(stage(_confirmed(_prefix_pairs(inside, links), sets), "forest_links"))


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace ``text`` by ``n_shingles``, ``component_id`` and ``kept`` in every row.

    Columns of these names that ``docs`` has are replaced.
    """
    docs = docs.drop("n_shingles", "component_id", "kept")
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("data")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("doc")
    keyed = docs.select(doc, data)
    signed = stage(keyed.mapInArrow(_signatures, _SIGNED), "forest_signatures")
    key = ["set_low", "set_high", "n_shingles"]
    classes = stage(
        signed.where("n_shingles > 0").groupBy(*key).agg(F.min("doc").alias("leader"), F.count(F.lit(1)).alias("rows")),
        "forest_classes",
    )
    # one row of each class, the one whose id leads it
    leaders = classes.select(F.col("leader").alias("doc"), *key)
    labelled = signed.join(leaders, ["doc", *key], "left_semi").select("doc", "n_shingles", "labels")
    known = components(_links(keyed, labelled))
    labels = known.select(F.col("node").alias("leader"), "component")
    found = (
        classes.join(labels, "leader", "left")
        .where("rows > 1 or component is not null")
        .select(*key, F.coalesce("component", "leader").alias("component"))
    )
    marked = signed.select("doc", *key).join(found, key, "left")
    return marked.select(
        F.when(F.col("doc") != _LAST_ID, F.col("doc")).alias("doc_id"),
        "n_shingles",
        F.coalesce("component", "doc").alias("component"),
    ).select(
        "doc_id",
        "n_shingles",
        F.when(F.col("component") != _LAST_ID, F.col("component")).alias("component_id"),
        F.col("doc_id").eqNullSafe(F.when(F.col("component") != _LAST_ID, F.col("component"))).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that are the first of their component; repeated rows of one stay."""
    gone = near_duplicates(docs.select("doc_id", "text")).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
