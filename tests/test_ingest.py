"""Text files that become stored chunks as they arrive."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from docloom.operators import calls, chunking, collection
from docloom.plans import stages
from docloom.sources import files
from docloom.streaming import ingest

SIZES = {"chunk_size": 300, "overlap": 30}


def put(folder, numbers):
    os.makedirs(folder, exist_ok=True)
    for n in numbers:
        sections = [f"# Part {i}\nThe body of part {i} of file {n}, which is {'long ' * (7 * i + n)}enough." for i in range(n % 4 + 1)]
        with open(os.path.join(folder, f"doc{n:02d}.txt"), "w") as out:
            out.write("\n\n".join(sections))


def lengths(texts):
    return [[float(len(t)), 1.0] for t in texts]


EMBED = collection.embedder(lengths, 2)


def names(spark):
    name = "i_" + uuid.uuid4().hex
    collection.open_collection(spark, name, slots=2, buckets=2)
    return name


def stored(spark, name):
    spark.catalog.refreshTable(name)
    return sorted((r.chunk_id, r.stable_id, r.document, r.metadata.source_file, tuple(r.embedding)) for r in spark.table(name).collect())


def run(spark, inbox, progress, name, **more):
    query = ingest.ingest_texts(spark, inbox, progress, EMBED, name, **SIZES, **more)
    assert query.awaitTermination(300)
    return stored(spark, name)


def test_three_batches_equal_one_run(spark, folder):
    inbox, progress, name = os.path.join(folder, "in"), os.path.join(folder, "progress"), names(spark)
    for numbers in ((1, 2, 3), (4,), (5, 7, 6)):
        put(inbox, numbers)
        with open(os.path.join(inbox, "doc99.txt"), "wb") as out:
            out.write(b"\xff")
        in_steps = run(spark, inbox, progress, name)
    texts, _ = files.read_texts(spark, inbox)
    chunks = stages.markdown_to_chunks(stages.texts_to_markdown(texts), **SIZES)
    at_once = names(spark)
    collection.add_chunks(spark, collection.chunk_rows(chunks, "stable_id"), EMBED, at_once, key="stable_id")
    assert in_steps == stored(spark, at_once) and len(in_steps) > 12
    # nothing new
    assert run(spark, inbox, progress, name) == in_steps
    # without its progress log everything arrives again
    assert run(spark, inbox, os.path.join(folder, "other"), name) == in_steps
    assert spark.table(f"{name}_rejects").count() == 1
    # and goes on behind all numbers
    put(inbox, (11,))
    after = run(spark, inbox, os.path.join(folder, "other"), name)
    numbers = [int(r[0].split("_")[1]) for r in after]
    assert set(in_steps) < set(after) and len(set(numbers)) == len(numbers)


def test_a_batch_that_fails_goes_on_where_it_was(spark, folder):
    inbox, progress, name = os.path.join(folder, "in"), os.path.join(folder, "progress"), names(spark)
    put(inbox, (1, 2))
    first = run(spark, inbox, progress, name, files_per_batch=1)
    assert spark.table(f"{name}__batches").count() == 2
    put(inbox, (3, 5))
    memory, log = calls.Memory(os.path.join(folder, "memory")), os.path.join(folder, "log")

    def convert(text):
        with open(log, "a") as out:
            out.write("x")
        return text.replace("body", "text")

    def failing(rows):
        wrong = F.raise_error(F.lit("no vectors")).cast("array<float>")
        return rows.select("*", wrong.alias("embedding"), F.lit(False).alias("embedding_missing"))

    query = ingest.ingest_texts(spark, inbox, progress, failing, name, convert=convert, memory=memory, **SIZES)
    with pytest.raises(Exception, match="no vectors"):
        query.awaitTermination(300)
    assert stored(spark, name) == first and os.path.getsize(log) == 2
    after = run(spark, inbox, progress, name, convert=convert, memory=memory)
    assert os.path.getsize(log) == 2  # converted before
    assert set(first) < set(after)
    numbers = sorted(int(r[0].split("_")[1]) for r in after)
    assert numbers == list(range(1, len(after) + 1))
    # a batch that ended but wasn't noted as done runs again with its own numbers
    assert ingest._first_number(spark, f"{name}__batches", progress, 1) == (len([r for r in first if "doc01" in r[3]]), True)


def test_numbers_go_on(spark):
    pieces = spark.createDataFrame([("a", 0, ["x", "y"]), ("b", 0, ["z"])], "source_file string, entry_pos int, pieces array<string>")
    got = chunking.number_entries(pieces, 40).collect()
    assert sorted((r.source_file, r.first_number) for r in got) == [("a", 40), ("b", 42)]
