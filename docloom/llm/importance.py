"""Target-distribution importance resampling on hashed n-grams.

A document is worth drawing if its n-grams are likelier in a target corpus than in the
corpus it comes from. Both are described by counts of n-grams in hashed buckets.

1. Tasks lower-case and blank a text's bytes by one table, split it, and extend the crc32
   of each word to that of the runs of two and three words, by giving it as the seed of the
   words behind (``byte_words``, ``_hashes``). A task reduces its batches in a Counter of
   buckets; Spark adds up the tasks' counters.
2. The buckets' counts of both corpora give a table of gains. It has ``buckets`` numbers
   whatever the corpora, and is what travels to the tasks.
3. A second pass over the texts adds up the gains of each document's features. Nothing but
   ids and three numbers leaves it.
4. Gumbel noise from a hash of the id makes the highest scores a weighted draw without
   replacement. Scores are numbered over range partitions, so no task ranks them all.

Definitions. Null and empty texts have no words; they get a weight of 0 and are never
drawn. A null id is hashed as an empty text, and comes before all others on equal scores.
Rows of one id are different documents with the same noise; equal scores of one id are
ranked by their numbers of features, then in the order of the rows. An empty corpus, or
an empty target, counts 0 in every bucket. Other columns play no part, whatever their
names; ``resample`` keeps them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import byte_words
from docloom.llm.common import stage
from docloom.operators.numbering import running_start

#: Buckets of features.
BUCKETS = 10_000
#: Words in the longest feature.
LONGEST = 3
#: Documents of fewer words are not drawn.
LEAST_WORDS = 20
#: Hundredths of the documents that can be drawn which are.
PERCENT = 5
#: Seed of the noise.
SEED = 42


def _hashes(words: list[bytes], carried: int) -> Iterator[list[int]]:
    """crc32 of the runs of 1, 2, ... words that end behind the ``carried`` first words."""
    spaced = [b" " + w for w in words]
    runs = list(map(crc32, words))
    for size in range(1, LONGEST + 1):
        if size > 1:
            # run i of ``size`` words is run i of one word less, extended by a word
            runs = list(map(crc32, islice(spaced, size - 1, None), runs))
        yield runs[max(0, carried - size + 1) :]


def _bucketed(text: bytes | None, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number of new words, and the buckets of the features, of each slice of a text."""
    for words, carried in byte_words.slices(text, LONGEST - 1):
        found = [np.array(runs, np.uint32) for runs in _hashes(words, carried)]
        yield len(words) - carried, np.concatenate(found) % np.uint32(buckets)


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    total: Counter[int] = Counter()
    for batch in batches:
        for text in batch.column("data"):
            for _, found in _bucketed(text.as_py(), buckets):
                total.update(found.tolist())
    if total:
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(list(total), pa.int32()), "n": pa.array(list(total.values()), pa.int64())}
        )


def _data(text: str) -> Column:
    return F.col(f"`{text}`").cast("binary").alias("data")


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts in each bucket that has any."""
    counted = docs.select(_data(text)).mapInArrow(partial(_count, buckets=buckets), "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket, from the ``bucket_counts`` of both corpora."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    own_total, aim_total = (
        x.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))
        for x, name in ((corpus, "own_total"), (target, "aim_total"))
    )
    counts = (
        every.join(corpus.withColumnRenamed("n", "own"), "bucket", "left")
        .join(target.withColumnRenamed("n", "aim"), "bucket", "left")
        .na.fill(0, ["own", "aim"])
        .crossJoin(F.broadcast(own_total))  # one row
        .crossJoin(F.broadcast(aim_total))  # one row
    )
    own, own_total, aim, aim_total = (
        F.col(c).cast("double") for c in ("own", "own_total", "aim", "aim_total")
    )
    ratio = ((aim + 1) * (own_total + buckets)) / ((own + 1) * (aim_total + buckets))
    return counts.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))


_WEIGHED = "n_words long, n_features long, weight long"


def _weigh(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        numbers = np.zeros((3, batch.num_rows), np.int64)
        for row, text in enumerate(batch.column("data")):
            for n_words, found in _bucketed(text.as_py(), len(table)):
                numbers[:, row] += (n_words, len(found), int(table[found].sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), *map(pa.array, numbers)],
            names=["row", "n_words", "n_features", "weight"],
        )


def weighed(docs: DataFrame, gain: DataFrame, text: str = "text") -> DataFrame:
    """(row, n_words, n_features, weight): ``row`` holds all columns of ``docs``.

    ``gain`` is the table of ``gains``, of a fixed number of rows, which the driver reads.
    """
    table = np.array([r.gain for r in gain.orderBy("bucket").collect()], np.int64)
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _data(text))
    out = T.StructType([given.schema["row"], *T.StructType.fromDDL(_WEIGHED).fields])
    return given.mapInArrow(partial(_weigh, table=table), out)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    uniform = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def _ranked(weights: DataFrame, doc_id: Column, percent: int, seed: int) -> DataFrame:
    """Add ``score`` and ``rank`` to rows of ``weighed``; rows that aren't drawn have no rank."""
    # written rows keep their places, which tell equal rows apart
    rows = stage(
        weights.select("*", doc_id.alias("id"), (F.col("weight") + noise(doc_id, seed)).alias("score")),
        "weights",
    ).withColumns(
        {
            "out": F.col("n_words") < LEAST_WORDS,
            "sinks": -F.col("score"),
            "place": F.monotonically_increasing_id(),
            "one": F.lit(1),
        }
    )
    drawn = percent * rows.where("not out").count() // 100
    numbered = running_start(rows, ["out", "sinks", "id", "n_features", "place"], "one")
    rank = F.when(
        ~F.col("out") & (F.col("running_start") < drawn), (F.col("running_start") + 1).cast("long")
    )
    return numbered.withColumn("rank", rank).drop("out", "sinks", "place", "one", "running_start")


def _gain(docs: DataFrame, target: DataFrame, text: str, buckets: int) -> DataFrame:
    counts = (stage(bucket_counts(x, text, buckets), "bucket_counts") for x in (docs, target))
    return gains(*counts, buckets)


def scores(
    docs: DataFrame,
    target: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    percent: int = PERCENT,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs``.

    ``rank`` numbers the drawn rows from 1; it is null for all others.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    weights = weighed(own, _gain(docs, target, text, buckets)).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_features", "weight"
    )
    ranked = _ranked(weights, F.col("doc_id"), percent, seed)
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def resample(
    docs: DataFrame,
    target: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    percent: int = PERCENT,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns.

    Whole rows take the way of the numbers in ``scores``, so that repeated rows and ids stay
    apart; only those that can be drawn at all are taken along.
    """
    weights = weighed(docs, _gain(docs, target, text, buckets), text).where(
        F.col("n_words") >= LEAST_WORDS
    )
    ranked = _ranked(weights, F.col("row").getField(doc_id), percent, seed)
    return ranked.where("rank is not null").select("row.*")


def digests(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Numbers of features, weight, score and rank, per document."""
    return scores(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
