"""Inserting into the collection, and the incremental ingest."""

import json
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from docloom.operators import collection
from docloom.schemas import CHUNK_METADATA, COLLECTION
from docloom.streaming.ingest import ingest_chunk_files

ROWS = "chunk_id string, document string, metadata struct<" + ",".join(
    f"{f.name}:{f.dataType.simpleString()}" for f in CHUNK_METADATA
) + ">"


def rows(spark, *pairs):
    return spark.createDataFrame([(i, d, (i, "f.json", "P", 1, 0, 1)) for i, d in pairs], ROWS)


def stored(spark, *pairs):
    return rows(spark, *pairs).select(
        "*", F.array(F.lit(1.0).cast("float")).alias("embedding"), F.lit(False).alias("embedding_missing")
    )


def lengths(texts):
    return [[float(len(t)), 0.0] for t in texts]


EMBED = collection.embedder(lengths, 2)


def content(df):
    return {r.chunk_id: r.document for r in df.collect()}


def table_name():
    return "c_" + uuid.uuid4().hex


def test_new_chunks_keep_repeats_and_missing_ids(spark):
    incoming = rows(spark, ("a", "1"), ("b", "2"), ("b", "3"), (None, "4"))
    got = collection.new_chunks(incoming, stored(spark, ("a", "x")))
    assert sorted((r.chunk_id or "", r.document) for r in got.collect()) == [("", "4"), ("b", "2"), ("b", "3")]


def test_default_ids_count_accepted_rows(spark):
    incoming = rows(spark, ("a", "r0"), (None, "r1"), ("old", "r2"), (None, "r3"), ("b", "r4"), (None, "r5"))
    ordered = incoming.withColumn("n", F.substr("document", F.lit(2)).cast("int"))
    got = collection.with_default_ids(ordered, stored(spark, ("old", ""), ("chunk_4", "")), ["n"])
    assert content(got) == {"a": "r0", "chunk_1": "r1", "chunk_2": "r3", "b": "r4"}


def test_force_modes(spark):
    incoming, old = rows(spark, ("a", "new"), ("b", "new")), stored(spark, ("a", "old"), ("z", "old"))

    def after(force):
        return content(collection.collection_after(incoming, old, EMBED, force))

    assert after(None) == {"a": "old", "z": "old", "b": "new"}
    assert after("ignore") == {"a": "old", "z": "old", "b": "new"}
    assert after("replace") == {"a": "new", "z": "old", "b": "new"}
    with pytest.raises(ValueError):
        after("other")


def test_only_missing_rows_are_embedded(spark):
    calls = spark.sparkContext.accumulator(0)

    def counted(texts):
        calls.add(len(texts))
        return lengths(texts)

    incoming = rows(spark, *[(str(i), "d") for i in range(20)])
    old = stored(spark, *[(str(i), "d") for i in range(15)])
    assert collection.insert_missing(incoming, old, collection.embedder(counted, 2)).count() == 5
    # counted again when the rows are written, but never for stored ones
    collection.insert_missing(incoming, old, collection.embedder(counted, 2)).toArrow()
    assert 0 < calls.value <= 10


def test_failed_embedding_yields_zeros_and_a_flag(spark):
    def picky(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("refused")
        return lengths(texts)

    got = collection.embedder(picky, 2)(rows(spark, ("a", "good"), ("b", "bad one"), ("c", "fine")))
    assert {r.chunk_id: (list(r.embedding), r.embedding_missing) for r in got.collect()} == {
        "a": ([4.0, 0.0], False),
        "b": ([0.0, 0.0], True),
        "c": ([4.0, 0.0], False),
    }


def test_attach_vectors(spark):
    vectors = spark.createDataFrame([("a", [1.0, 2.0])], "chunk_id string, embedding array<float>")
    got = collection.attach_vectors(rows(spark, ("a", ""), ("b", "")), vectors)
    flags = {r.chunk_id: (len(r.embedding), r.embedding_missing) for r in got.collect()}
    assert flags == {"a": (2, False), "b": (768, True)}


def test_failed_replacement_leaves_the_old_table(spark):
    def failing(incoming):
        vector = F.raise_error(F.concat(F.lit("no "), "document")).cast("array<float>")
        return incoming.select("*", vector.alias("embedding"), F.lit(False).alias("embedding_missing"))

    name = table_name()
    collection.add_chunks(spark, rows(spark, ("a", "1"), ("b", "2")), EMBED, name)
    with pytest.raises(Exception, match="no x"):
        collection.add_chunks(spark, rows(spark, ("a", "x")), failing, name, "replace")
    assert content(spark.table(name)) == {"a": "1", "b": "2"}
    assert content(collection.add_chunks(spark, rows(spark, ("a", "x")), EMBED, name, "replace")) == {"a": "x", "b": "2"}


def test_replacement_broken_off_between_renames(spark):
    name = table_name()
    collection.add_chunks(spark, rows(spark, ("a", "1")), EMBED, name)
    spark.sql(f"alter table {name} rename to {name}__old")
    assert content(collection.open_collection(spark, name)) == {"a": "1"}


def test_table_life(spark):
    name = table_name()
    assert collection.open_collection(spark, name).schema == COLLECTION
    assert collection.open_collection(spark, name).count() == 0
    assert content(collection.add_chunks(spark, rows(spark, ("a", "1"), ("b", "2")), EMBED, name)) == {"a": "1", "b": "2"}
    again = rows(spark, ("a", "x"), ("c", "3"))
    assert content(collection.add_chunks(spark, again, EMBED, name)) == {"a": "1", "b": "2", "c": "3"}
    assert content(collection.add_chunks(spark, again, EMBED, name, "ignore")) == {"a": "1", "b": "2", "c": "3"}
    assert content(collection.add_chunks(spark, again, EMBED, name, "replace")) == {"a": "x", "b": "2", "c": "3"}
    info = collection.collection_info(spark.table(name), name, "here").first()
    assert tuple(info) == (name, 3, "here")
    assert {r.chunk_id for r in collection.existing_ids(spark.table(name)).collect()} == {"a", "b", "c"}


def files_of(spark, name):
    found = spark.table(name).select("slot", F.col("_metadata.file_path").alias("file")).distinct().collect()
    return {(r.slot, r.file) for r in found}


def test_replacement_leaves_the_files_of_other_slots_alone(spark):
    name = table_name()
    collection.open_collection(spark, name, slots=16, buckets=3)
    given = rows(spark, *[(f"k{i}", "old") for i in range(300)]).withColumn("stable_id", F.concat(F.lit("s"), "chunk_id"))
    collection.add_chunks(spark, given, EMBED, name, key="stable_id")
    before = files_of(spark, name)
    reader = spark.table(name)  # a reader that has looked up its files
    assert reader.where("document = 'old'").count() == 300
    new = rows(spark, ("k7", "new"), ("k9", "new"), ("added", "new"))
    after = collection.add_chunks(spark, new, EMBED, name, "replace")
    assert content(after) == {f"k{i}": "old" for i in range(300)} | {"k7": "new", "k9": "new", "added": "new"}
    touched = {r.slot for r in spark.table(name).where("document = 'new'").select("slot").collect()}
    assert 1 <= len(touched) <= 3
    now = files_of(spark, name)
    assert {x for x in now if x[0] not in touched} == {x for x in before if x[0] not in touched}
    assert not {f for s, f in now if s in touched} & {f for _, f in before}
    # the index followed: replaced rows have lost their stable ids
    known = {r.stable_id for r in collection.stable_index(spark, name).collect()}
    assert known == {f"sk{i}" for i in range(300) if i not in (7, 9)} | {"\0k7", "\0k9", "\0added"}
    dropped = collection.drop_old_versions(spark, name)
    assert len(dropped) >= len(touched) and files_of(spark, name) == now
    assert content(spark.table(name)) == content(after)
    assert collection.drop_old_versions(spark, name) == []
    # appended rows go where the replaced slots lie now
    more = collection.add_chunks(spark, rows(spark, *[(f"m{i}", "more") for i in range(50)]), EMBED, name)
    assert more.count() == 351 and collection.drop_old_versions(spark, name) == []


def test_stored_rows_do_not_move_for_an_insert(spark):
    name = table_name()
    given = rows(spark, *[(f"k{i}", "d") for i in range(50)]).withColumn("stable_id", F.concat(F.lit("s"), "chunk_id"))
    collection.add_chunks(spark, given, EMBED, name, key="stable_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stored, key in ((collection.open_collection(spark, name), "chunk_id"), (collection.stable_index(spark, name), "stable_id")):
            plan = collection.new_chunks(given, stored, key)._jdf.queryExecution().executedPlan().toString()
            stored_side = re.split(r"\n +\+- Sort", plan)[-1]
            assert "Bucketed: true" in stored_side and "Exchange" not in stored_side
            assert f"ReadSchema: struct<{key}:string>" in stored_side
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_index_left_behind_is_made_up_for(spark):
    name = table_name()
    given = rows(spark, *[(f"k{i}", "d") for i in range(40)]).withColumn("stable_id", F.concat(F.lit("s"), "chunk_id"))
    collection.add_chunks(spark, given.where("chunk_id < 'k2'"), EMBED, name, key="stable_id")
    index = f"{name}__stable"
    spark.sql(f"alter table {index} rename to {index}_kept")
    collection.add_chunks(spark, given.where("chunk_id >= 'k2'"), EMBED, name)  # breaks off before the index
    spark.sql(f"alter table {index}_kept rename to {index}")
    renumbered = given.withColumn("chunk_id", F.concat(F.lit("other"), "chunk_id"))
    after = collection.add_chunks(spark, renumbered, EMBED, name, key="stable_id")
    assert sorted(content(after)) == sorted(f"k{i}" for i in range(40))
    assert spark.table(index).count() == 40


def test_a_table_of_an_older_version_is_laid_out(spark):
    name = table_name()
    old = EMBED(rows(spark, ("a", "1"), ("b", "2"))).select("*", F.lit(None).cast("string").alias("stable_id"), F.lit(None).cast("string").alias("metadata_json"))
    old.select(*COLLECTION.fieldNames()).write.saveAsTable(name)
    assert content(collection.add_chunks(spark, rows(spark, ("b", "x"), ("c", "3")), EMBED, name, "replace")) == {"a": "1", "b": "x", "c": "3"}
    assert "slot" in spark.table(name).columns


def test_repeated_ids_in_one_insert_are_refused(spark):
    name = table_name()
    with pytest.raises(ValueError, match="duplicate"):
        collection.add_chunks(spark, rows(spark, ("a", "1"), ("a", "2")), EMBED, name)
    with pytest.raises(ValueError, match="missing"):
        collection.add_chunks(spark, rows(spark, (None, "1")), EMBED, name)
    with pytest.raises(ValueError, match="unknown"):
        collection.add_chunks(spark, rows(spark, ("a", "1")), EMBED, name, "other")
    assert collection.open_collection(spark, name).count() == 0


def test_rows_without_ids_are_named_on_insert(spark):
    name = table_name()
    incoming = rows(spark, ("a", "r0"), (None, "r1"), ("b", "r2"), (None, "r3"))
    after = collection.add_chunks(spark, incoming, EMBED, name, order=["document"])
    assert content(after) == {"a": "r0", "chunk_1": "r1", "b": "r2", "chunk_3": "r3"}


def test_an_insert_embeds_each_row_once(spark):
    name, calls = table_name(), spark.sparkContext.accumulator(0)

    def counted(texts):
        calls.add(len(texts))
        return lengths(texts)

    collection.add_chunks(spark, rows(spark, ("a", "1"), ("b", "2")), collection.embedder(counted, 2), name)
    assert calls.value == 2


def test_chunk_rows(spark):
    chunks = spark.createDataFrame([(None, None)], "content string, metadata " + CHUNK_METADATA.simpleString())
    assert tuple(collection.chunk_rows(chunks).first()) == (None, "", None)


def test_incremental_ingest(spark, folder):
    name, inbox = table_name(), os.path.join(folder, "in")
    os.mkdir(inbox)

    def drop(file, *ids):
        items = [{"content": i, "metadata": {"chunk_id": i, "source_file": file}} for i in ids]
        items += [{"content": f"unnamed in {file}"}]
        with open(os.path.join(inbox, file), "w", encoding="utf-8") as out:
            json.dump(items, out, ensure_ascii=False)

    def run():
        query = ingest_chunk_files(spark, inbox, os.path.join(folder, "progress"), EMBED, name)
        assert query.awaitTermination(120)
        spark.catalog.refreshTable(name)
        return sorted(content(spark.table(name)))

    drop("one.json", "a", "é")
    with open(os.path.join(inbox, "broken.json"), "w") as out:
        out.write("{ nope")
    with open(os.path.join(inbox, "bytes.json"), "wb") as out:
        out.write(b"[\xff]")
    assert run() == ["a", "chunk_2", "é"]
    drop("two.json", "a", "c")
    # the second file has one accepted row before its unnamed one
    assert run() == ["a", "c", "chunk_1", "chunk_2", "é"]
    assert run() == ["a", "c", "chunk_1", "chunk_2", "é"]
    rejected = {r.source_file: r.reason for r in spark.table(f"{name}_rejects").collect()}
    assert set(rejected) == {"broken.json", "bytes.json"}


def test_an_ingest_that_runs_again_adds_nothing(spark, folder):
    name, inbox = table_name(), os.path.join(folder, "in")
    os.mkdir(inbox)
    with open(os.path.join(inbox, "rows.json"), "w") as out:
        json.dump([{"content": "one"}, {"content": "two", "metadata": {"chunk_id": "t"}}, {"content": "one"}], out)
    for progress in ("first", "lost"):  # without its progress log everything is new again
        query = ingest_chunk_files(spark, inbox, os.path.join(folder, progress), EMBED, name)
        assert query.awaitTermination(120)
        spark.catalog.refreshTable(name)
        assert sorted(content(spark.table(name))) == ["chunk_0", "chunk_2", "t"]


def test_known_rows_are_not_embedded_again(spark):
    name, calls = table_name(), spark.sparkContext.accumulator(0)

    def counted(texts):
        calls.add(len(texts))
        return lengths(texts)

    embed = collection.embedder(counted, 2)
    collection.add_chunks(spark, rows(spark, ("a", "1"), ("b", "2")), embed, name)
    assert calls.value == 2
    for force in (None, "ignore"):
        collection.add_chunks(spark, rows(spark, ("a", "x"), ("b", "2")), embed, name, force)
    assert calls.value == 2
    stable = rows(spark, ("c", "3")).withColumn("stable_id", F.lit("s3"))
    collection.add_chunks(spark, stable, embed, name, key="stable_id")
    collection.add_chunks(spark, stable.withColumn("chunk_id", F.lit("renumbered")), embed, name, key="stable_id")
    assert calls.value == 3 and sorted(content(spark.table(name))) == ["a", "b", "c"]


def test_embeddings_of_wrong_number_or_width_are_flagged(spark):
    def odd(texts):
        return [[1.0, 2.0][: len(t)] for t in texts][: 1 if len(texts) > 2 else None]

    out = collection.embedder(odd, 2)(rows(spark, ("a", "xx"), ("b", "x"), ("c", "xxx")).coalesce(1)).collect()
    assert {r.chunk_id: r.embedding_missing for r in out} == {"a": False, "b": True, "c": False}
    assert all(len(r.embedding) == 2 for r in out)
