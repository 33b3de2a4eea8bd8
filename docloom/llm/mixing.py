"""Mixing sources to target weights, in native operations only.

The words of each source, in the order of its documents, are packed into blocks of
``BLOCK`` words. A target of words per source becomes a number of slots. Output shards
of ``SHARD`` slots draw how many of their slots each source fills, by multinomial draws
from a hash; draws beyond a source's slots are given up, and a last shard takes what is
still missing, so that the targets are met. ``assembled`` lists what each shard holds. Slot ``j`` of a source stands for the block
that a pseudorandom permutation (a swap-or-not shuffle, which is a bijection on any
number of blocks) gives it, a new permutation for every pass over the source. Joining
slots and blocks by that index gives what the mix takes of every document.

Places of words come from a distributed running sum, so that a source with a third of
all documents is no hot key; the table of sources has one row per source and is the only
thing that is ordered in one task.

Definitions. Words are runs of anything but space and \\x09 to \\x0D; null text has none.
Null is a source of its own, the last one. Targets are ``SHARE`` times all words,
shared by the weights 5, 2, 1, repeating, over the sources by code point; no target is
above ``EPOCHS`` times its source's words, and what is above is shared by the others.
The mix is a function of the rows alone: reruns agree. Repeated rows are separate
documents, which may be taken to a different extent; which of several equal rows is taken
is open. Other columns play no part, whatever their names, and ``mixed`` hands them on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import WORD, doc_key, stage
from docloom.operators.numbering import running_start

#: Words in a block.
BLOCK = 128
#: Slots in an output shard.
SHARD = 1024
#: Words of the mix, relative to those of all documents.
SHARE = 1.5
#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: Times that a source may be taken.
EPOCHS = 2
#: Rounds of the permutation.
ROUNDS = 16
SEED = 17

_SPACE = r"[\x20\x09-\x0D]"


def word_count(text: str) -> Column:
    """Number of words: each becomes one letter, white space goes."""
    letters = F.regexp_replace(F.col(text), WORD, "x")
    return F.coalesce(F.length(F.translate(letters, " \t\n\x0b\f\r", "")), F.lit(0)).cast("long")


def _everything():
    """All rows of the table of sources."""
    return Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def targets(sources: DataFrame) -> DataFrame:
    """Add ``target`` to (source, source_size).

    Targets are min(EPOCHS * size, level * weight). With the sources ordered by the level
    at which they fill up, the level is the largest one that follows from taking the
    first few as full.
    """
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    weighed = sources.withColumn("place", place).withColumn("weight", weight.cast("double"))
    most = F.col("source_size") * F.lit(float(EPOCHS))
    order = Window.orderBy(most / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = _everything()
    full = F.coalesce(F.sum(most).over(before), F.lit(0.0))
    levels = weighed.withColumn("all_words", F.sum("source_size").over(everything)).withColumn(
        "level", (F.lit(SHARE) * F.col("all_words") - full) / F.sum("weight").over(rest)
    )
    level = F.max("level").over(everything)
    return levels.withColumn("level", level).select(
        *sources.columns, "place", F.least(most, F.col("level") * F.col("weight")).alias("target")
    )


def _hash(*parts: Column | str | int) -> Column:
    return F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """Place of ``index`` in a pseudorandom permutation of ``size`` numbers."""

    def turn(place: Column, round_: Column) -> Column:
        other = F.pmod(_hash("turn", SEED, round_, *key) - place, size)
        heads = _hash("swap", SEED, round_, *key, F.greatest(place, other)).bitwiseAND(F.lit(1))
        return F.when(heads == 1, other).otherwise(place)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), turn)


def _slots(sources: DataFrame) -> DataFrame:
    """(place, shard, pass, block, words): each slot's block and how many of its words count."""
    size, blocks = F.col("source_size"), F.ceil(F.col("source_size") / BLOCK)
    words = F.round("target").cast("long")
    passes = F.floor(words / size)
    wanted = F.when(size > 0, passes * blocks + F.ceil((words - passes * size) / BLOCK)).otherwise(0)
    planned = sources.withColumn("blocks", blocks).withColumn("slots", wanted.cast("long"))
    ends = F.sum("slots").over(Window.orderBy("place"))
    bounds = planned.withColumn("ends", ends).agg(
        F.sort_array(F.collect_list(F.struct("ends", "place"))).alias("bounds"),
        F.max("ends").alias("all_slots"),
    )
    # one row a shard; the draws are counted before they are shuffled. Few rows become
    # many here, so they are spread first, over a number that Spark doesn't reduce.
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = F.ceil(F.coalesce("all_slots", F.lit(0)) / SHARD)
    shards = bounds.where("all_slots > 0").select(
        "bounds", "all_slots", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("shard")
    )
    first = F.col("shard") * SHARD
    in_shard = F.least(F.lit(SHARD).cast("long"), F.col("all_slots") - first)
    draw = shards.repartition(tasks, "shard").select(
        "bounds", "all_slots", "shard", F.explode(F.sequence(first, first + in_shard - 1)).alias("slot")
    )
    drawn = F.pmod(_hash("draw", SEED, F.col("slot")), F.col("all_slots"))
    source = F.filter("bounds", lambda b: b["ends"] > F.col("drawn"))[0]["place"]
    counts = (
        draw.withColumn("drawn", drawn)
        .select("shard", source.alias("place"))
        .groupBy("shard", "place")
        .agg(F.count(F.lit(1)).alias("drawn"))
    )
    plan = planned.select("place", "source_size", "target", "blocks", "slots")
    # the slots that earlier shards have drawn of a source, summed over ranges of shards
    summed = running_start(counts, ["place", "shard"], "drawn")
    totals = summed.groupBy("place").agg(
        F.min("running_start").alias("base"), F.sum("drawn").alias("all_drawn")
    )
    planned_draws = plan.join(totals, "place", "left")
    start = F.col("running_start") - F.col("base")
    drawn_slots = summed.join(planned_draws, "place").select(
        *plan.columns,
        "shard",
        start.alias("start"),
        F.least(start + F.col("drawn"), F.col("slots")).alias("stop"),
    )
    # a last shard takes the slots that no draw has filled
    shards_of_draws = F.ceil(F.sum("slots").over(_everything()) / SHARD)
    missing = planned_draws.withColumn("shard", shards_of_draws).select(
        *plan.columns, "shard", F.coalesce("all_drawn", F.lit(0)).alias("start"), F.col("slots").alias("stop")
    )
    filled = drawn_slots.union(missing).where("start < stop")
    slots = filled.repartition(tasks, "place", "start").select(
        *plan.columns, "shard", F.explode(F.sequence("start", F.col("stop") - 1)).alias("slot")
    )
    pass_, within = F.floor(F.col("slot") / F.col("blocks")), F.col("slot") % F.col("blocks")
    taken_before = pass_ * F.col("source_size") + within * BLOCK
    return slots.select(
        "place",
        "shard",
        pass_.alias("pass"),
        permuted(within, F.col("blocks"), F.col("place"), pass_).alias("block"),
        F.least(F.lit(BLOCK), words - taken_before).cast("long").alias("words"),
    )


#: What is known of a document, next to its place. ``number`` tells equal rows apart.
_DOCUMENT = ["number", "doc_id", "size", "source", "source_size", "target"]


def _pieces(docs: DataFrame, text: str) -> DataFrame:
    """(shard, pass, first, stop) and what is known of the document: the words of every
    document that each slot takes. What no slot takes has null, or no words.

    ``number`` of ``docs`` is a different one for every row.
    """
    sized = docs.select(
        "number",
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        *doc_key(text),
        word_count(text).alias("size"),
    )
    # the number comes last, so that equal rows are spread over tasks
    order = ["source", "doc", "mark", "size", "number"]
    numbered = stage(running_start(sized, order, "size").drop("doc", "mark"), "mix_documents")
    sources = stage(
        targets(
            numbered.groupBy("source").agg(
                F.sum("size").alias("source_size"), F.min("running_start").alias("source_start")
            )
        ),
        "mix_sources",
    )
    named = numbered.join(
        sources.withColumnRenamed("source", "of_source"),
        F.col("source").eqNullSafe(F.col("of_source")),
    ).drop("of_source")
    begin = F.col("running_start") - F.col("source_start")
    blocks = F.sequence(
        F.floor(begin / BLOCK), F.floor((begin + F.col("size") - 1) / BLOCK)
    )
    pieces = named.withColumn("begin", begin).withColumn(
        "block", F.explode_outer(F.when(F.col("size") > 0, blocks))
    )
    begin = F.col("block") * BLOCK - F.col("begin")
    # the slots grow with the input, which their estimated size doesn't show
    return pieces.join(_slots(sources).hint("merge"), ["place", "block"], "left").select(
        *_DOCUMENT,
        "shard",
        "pass",
        F.greatest(begin, F.lit(0)).alias("first"),
        F.least(begin + F.col("words"), F.col("size")).alias("stop"),
    )


def _some(pieces: DataFrame) -> Column:
    """Whether a piece has words."""
    return pieces["pass"].isNotNull() & (F.col("size") > 0) & (F.col("stop") > F.col("first"))


def _with_numbers(docs: DataFrame, text: str) -> DataFrame:
    return docs.select("doc_id", "source", text, F.monotonically_increasing_id().alias("number"))


def mix(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) of every document."""
    # the numbers are read from where the running sum has written them
    pieces = _pieces(_with_numbers(docs, text), text)
    words = F.when(_some(pieces), F.col("stop") - F.col("first")).otherwise(0)
    return (
        pieces.groupBy(*_DOCUMENT)
        .agg(F.sum(words).cast("long").alias("taken"))
        .select(*_DOCUMENT[1:], "taken")
    )


def assembled(docs: DataFrame, text: str = "text") -> DataFrame:
    """What each output shard holds: (shard, source, doc_id, pass, first, stop), the words
    ``first`` up to ``stop`` of a document, in one pass over its source."""
    pieces = _pieces(_with_numbers(docs, text), text)
    return pieces.where(_some(pieces)).select("shard", "source", "doc_id", "pass", "first", "stop")


def shares(docs: DataFrame) -> DataFrame:
    """What the mix takes, per document."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents as the mix takes them.

    Every pass over a source gives a document once more: the text as it is where the pass
    takes all of it, or else the words of the drawn blocks in the order of the text, each
    with the white space behind it. What a pass doesn't take is left out. ``n_chars`` is
    counted anew.
    """
    # each row is one value with a number, which is written, so that both reads agree and
    # no column of the documents meets one of the mix
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = stage(docs.select(row, F.monotonically_increasing_id().alias("number")), "mix_rows")
    pieces = _pieces(rows.select("number", *[F.col(f"row.{c}") for c in ("doc_id", "source", "text")]), "text")
    taken = (
        pieces.where(_some(pieces))
        .groupBy("number", "size")
        .agg(F.sort_array(F.collect_list(F.struct("pass", "first", "stop"))).alias("drawn"))
    )
    copies = F.transform(
        F.array_distinct(F.col("drawn.pass")),
        lambda p: F.filter("drawn", lambda d: d["pass"] == p),
    )
    rows = rows.join(taken, "number").select("row", "size", F.explode(copies).alias("copy"))
    text = F.col("row.text")
    n_taken = F.aggregate(
        "copy", F.lit(0).cast("long"), lambda n, d: n + d["stop"] - d["first"]
    )
    words = F.regexp_extract_all(text, F.lit(f"({WORD}{_SPACE}*)"), F.lit(1))

    def piece(words: Column, d: Column) -> Column:
        n = (d["stop"] - d["first"]).cast("int")
        return F.array_join(F.slice(words, (d["first"] + 1).cast("int"), n), "")

    # the words are cut out once for all pieces
    cut = F.transform(
        F.array(words), lambda w: F.array_join(F.transform("copy", lambda d: piece(w, d)), "")
    )[0]
    cut = F.regexp_replace(cut, rf"{_SPACE}+\z", "")
    rows = rows.select("row", F.when(n_taken >= F.col("size"), text).otherwise(cut).alias("cut"))
    new = {"text": F.col("cut"), "n_chars": F.length("cut").cast("long")}
    return rows.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
