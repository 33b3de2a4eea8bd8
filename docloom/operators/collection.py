"""The vector collection: rows (chunk_id, stable_id, document, metadata, metadata_json, embedding,
embedding_missing).

The table is partitioned by a slot of the id's hash and bucketed by the id within. Looking
up which of some new ids are stored joins buckets and moves no stored row; replacing rows
writes the slots that hold them and leaves the files of all others alone. Each slot takes on
its new version by one change of its location in the catalog.

Beside it lies an index of the stable ids, in the same slots and bucketed by stable id. It
is appended to after the collection; a slot whose counts differ, since an insert broke off in
between, is indexed again before the index is next used.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.vectors import zero_vector
from docloom.operators import calls
from docloom.operators.numbering import running_start
from docloom.schemas import COLLECTION
from docloom.shared import write_stage

# Fixed values.
EMBEDDING_DIM = 768
COLLECTION_NAME = "document_chunks"

# Parts of a new collection that are replaced as a whole; a large one should have thousands.
SLOTS = 16

Embed = Callable[[DataFrame], DataFrame]


def _slot(slots: int) -> Column:
    return F.pmod(F.xxhash64("chunk_id"), F.lit(slots)).cast("int").alias("slot")


def _write_slots(
    df: DataFrame, name: str, key: str, buckets: int, mode: str = "error", path: str | None = None
) -> None:
    """Write rows that have a ``slot``; one task writes a bucket of all slots."""
    writer = (
        df.repartition(buckets, key)
        .write.format("parquet")
        .mode(mode)
        .partitionBy("slot")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    df.sparkSession.catalog.refreshTable(name)


def _property(spark: SparkSession, name: str, key: str) -> int | None:
    value = spark.sql(f"show tblproperties {name}('docloom.{key}')").first().value
    return int(value) if value.isdigit() else None


def _layout(spark: SparkSession, name: str) -> tuple[int, int]:
    """Slots and buckets of a collection."""
    return _property(spark, name, "slots"), _property(spark, name, "buckets")


def _create(rows: DataFrame, name: str, slots: int, buckets: int, path: str | None = None) -> None:
    spark = rows.sparkSession
    _write_slots(rows.select("*", _slot(slots)), name, "chunk_id", buckets, path=path)
    spark.sql(f"alter table {name} set tblproperties ('docloom.slots'='{slots}', 'docloom.buckets'='{buckets}')")


def _index_name(name: str) -> str:
    return f"{name}__stable"


def open_collection(
    spark: SparkSession, name: str = COLLECTION_NAME, slots: int = SLOTS, buckets: int | None = None
) -> DataFrame:
    """The collection table, created empty with this layout if it does not exist.

    A table without slots, as older versions wrote it, is laid out once. If that was broken
    off between its renames, the table gets its name back.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}__old"):
        spark.sql(f"alter table {name}__old rename to {name}")
    if not spark.catalog.tableExists(name):
        _create(spark.createDataFrame([], COLLECTION), name, slots, buckets)
    elif "slot" not in spark.table(name).columns:
        new = f"{name}__{uuid.uuid4().hex}"
        # with a path of its own: renaming a table doesn't move the slots it knows
        _create(spark.table(name), new, slots, buckets, f"{_table_path(spark, name)}_{uuid.uuid4().hex}")
        _swap(spark, new, name)
    return spark.table(name).drop("slot")


def _swap(spark: SparkSession, new: str, name: str) -> None:
    """Give a table the name of another one, which is dropped."""
    old = f"{name}__old"
    spark.sql(f"drop table if exists {old}")
    spark.sql(f"alter table {name} rename to {old}")
    spark.sql(f"alter table {new} rename to {name}")
    spark.sql(f"drop table {old}")


def stable_index(spark: SparkSession, name: str) -> DataFrame:
    """(stable_id, slot) of every row of a collection; a row without a stable id has one
    that no other row can have. Slots that aren't up to date are indexed again."""
    index, (slots, buckets) = _index_name(name), _layout(spark, name)
    if not spark.catalog.tableExists(index):
        _write_slots(_index_rows(spark.table(name).limit(0), slots), index, "stable_id", buckets)
    counts = [spark.table(t).groupBy("slot").count() for t in (name, index)]
    differ = counts[0].join(counts[1].withColumnRenamed("count", "known"), "slot", "full")
    late = [r.slot for r in differ.where("not (count <=> known)").collect()]  # at most one a slot
    if late:
        stale = _index_rows(spark.table(name).where(F.col("slot").isin(late)), slots)
        _replace_slots(stale, index, "stable_id", buckets, late)
    return spark.table(index)


def _index_rows(rows: DataFrame, slots: int) -> DataFrame:
    own = F.concat(F.lit("\0"), "chunk_id")
    return rows.select(F.coalesce("stable_id", own).alias("stable_id"), _slot(slots))


def _table_path(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"describe table extended {name}").where("col_name = 'Location'")
    return rows.first().data_type


def _replace_slots(rows: DataFrame, name: str, key: str, buckets: int, slots: list[int]) -> None:
    """Let ``rows`` be all rows of the listed slots, and leave the other slots alone.

    They are written below the table's folder first; a write that fails changes nothing.
    Then each slot is pointed to its new files, one by one: a reader sees a slot as it was or
    as it is now. Files of earlier versions stay for those who still read them, until
    ``drop_old_versions``.
    """
    spark, fresh = rows.sparkSession, f"{name}__{uuid.uuid4().hex}"
    path = f"{_table_path(spark, name)}/_versions/{uuid.uuid4().hex}"
    _write_slots(rows, fresh, key, buckets, path=path)
    written = {r.slot for r in spark.table(fresh).select("slot").distinct().collect()}
    known = {int(r.partition.partition("=")[2]) for r in spark.sql(f"show partitions {name}").collect()}
    for slot in sorted(slots):
        which = f"partition (slot={slot})"
        if slot not in written:
            if slot in known:
                spark.sql(f"alter table {name} drop {which}")
        elif slot in known:
            spark.sql(f"alter table {name} {which} set location '{path}/slot={slot}'")
        else:
            spark.sql(f"alter table {name} add {which} location '{path}/slot={slot}'")
    spark.sql(f"drop table {fresh}")  # external: its files stay
    spark.catalog.refreshTable(name)


def drop_old_versions(spark: SparkSession, name: str = COLLECTION_NAME) -> list[str]:
    """Delete files of slots that have been replaced; to be run when nobody reads them any more."""
    dropped = []
    for table in (name, _index_name(name)):
        if not spark.catalog.tableExists(table):
            continue
        used = set()
        for r in spark.sql(f"show partitions {table}").collect():
            which = r.partition.replace("slot=", "slot = ")
            about = spark.sql(f"describe table extended {table} partition ({which})")
            used.add(about.where("col_name = 'Location'").first().data_type)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        top = jvm.org.apache.hadoop.fs.Path(_table_path(spark, table))
        fs = top.getFileSystem(conf)
        used = {jvm.org.apache.hadoop.fs.Path(p).toUri().getPath() for p in used}
        for pattern in ("slot=*", "_versions/*/slot=*"):
            for found in fs.globStatus(jvm.org.apache.hadoop.fs.Path(top, pattern)) or []:
                if found.getPath().toUri().getPath() not in used:
                    fs.delete(found.getPath(), True)
                    dropped.append(found.getPath().toString())
    return dropped


def existing_ids(collection: DataFrame) -> DataFrame:
    return collection.select("chunk_id").distinct()


def collection_info(collection: DataFrame, name: str, path: str) -> DataFrame:
    return collection.agg(
        F.lit(name).alias("collection_name"),
        F.count(F.lit(1)).alias("document_count"),
        F.lit(path).alias("database_path"),
    )


def chunk_rows(chunks: DataFrame, *kept: str) -> DataFrame:
    """Chunks (content, metadata) -> rows (chunk_id, document, metadata, ...); id may be null."""
    return chunks.select(
        F.col("metadata.chunk_id").alias("chunk_id"),
        F.coalesce("content", F.lit("")).alias("document"),
        "metadata",
        *kept,
    )


def new_chunks(rows: DataFrame, collection: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Rows whose ``key`` is not stored. Rows without one, and repeated keys, stay.

    Rows without a key get keys of their own, which no stored row has, so that
    they do not meet in one task.
    """
    unnamed = F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string"))
    keyed = rows.withColumn("join_key", F.coalesce(key, unnamed))
    stored = collection.select(F.col(key).alias("join_key"))
    return keyed.join(stored, "join_key", "left_anti").select(*rows.columns)


def with_default_ids(rows: DataFrame, collection: DataFrame, order: list[str]) -> DataFrame:
    """New rows, with ``chunk_{n}`` for a missing id, n rows being accepted before it.

    ``order`` is a unique key of ``rows`` that gives the input order. A row whose
    default id is stored is rejected; it does count for the numbers behind it.
    """
    fresh = new_chunks(rows, collection)
    numbered = running_start(
        fresh.select(*order, F.col("chunk_id").isNull().alias("unnamed"), F.lit(1).alias("one")),
        order,
        "one",
    )
    named = numbered.where("unnamed").select(
        *order, F.format_string("chunk_%d", "running_start").alias("default_id")
    )
    free = named.join(
        collection.select(F.col("chunk_id").alias("default_id")), "default_id", "left_anti"
    )
    return (
        fresh.join(free, order, "left")
        .withColumn("chunk_id", F.coalesce("chunk_id", "default_id"))
        .where(F.col("chunk_id").isNotNull())
        .select(*rows.columns)
    )


def attach_vectors(rows: DataFrame, vectors: DataFrame, dim: int = EMBEDDING_DIM) -> DataFrame:
    """Join precomputed vectors (chunk_id, embedding); without one: zeros and a flag."""
    joined = rows.join(vectors.select("chunk_id", "embedding"), "chunk_id", "left")
    return _zero_filled(joined, rows.columns, dim)


def _zero_filled(df: DataFrame, columns: list[str], dim: int) -> DataFrame:
    return df.select(
        *columns,
        F.coalesce("embedding", zero_vector(dim)).alias("embedding"),
        F.col("embedding").isNull().alias("embedding_missing"),
    )


def embedder(
    embed: Callable[[list[str]], list[list[float]]],
    dim: int = EMBEDDING_DIM,
    call_size: int = 256,
    memory: calls.Memory | None = None,
    retry: calls.Retry = calls.Retry(),
) -> Embed:
    """Wrap an embedding function of a list of texts.

    It is called for ``call_size`` texts at a time; if that raises, or doesn't return
    one vector of ``dim`` components for each, as often as ``retry`` says, once per text,
    and a text for which it still fails gets zeros and the flag. With a ``memory``, a text
    that was embedded before is not embedded again.
    """
    vector = T.ArrayType(T.FloatType())

    def checked(texts: list[str]) -> list[list[float]]:
        vectors = [[float(x) for x in v] for v in embed(texts)]
        if any(len(v) != dim for v in vectors):
            raise ValueError("a vector of another width")
        return vectors

    @F.pandas_udf(vector)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            vectors: list[list[float] | None] = []
            for begin in range(0, len(batch), call_size):
                vectors += calls.each(checked, batch.iloc[begin : begin + call_size].tolist(), retry)
            yield pd.Series(vectors, index=batch.index, dtype="object")

    def attach(rows: DataFrame) -> DataFrame:
        if memory is None:
            embedded = rows.withColumn("embedding", run("document"))
        else:
            found = calls.remembered(rows, "document", checked, vector, memory, call_size, retry)
            embedded = found.withColumnRenamed("result", "embedding")
        return _zero_filled(embedded, rows.columns, dim)

    return attach


def insert_missing(rows: DataFrame, collection: DataFrame, embed: Embed) -> DataFrame:
    """The rows to append: those not stored yet. Only these are embedded."""
    return embed(new_chunks(rows, collection))


def collection_after(
    rows: DataFrame, collection: DataFrame, embed: Embed, force: str | None = None
) -> DataFrame:
    """The collection after an insert.

    ``None`` and ``"ignore"`` embed and add what is missing. ``"replace"`` embeds every
    row and puts it in the place of a stored one.
    """
    if force == "replace":
        kept, added = new_chunks(collection, rows), embed(rows)
    elif force in (None, "ignore"):
        kept, added = collection, insert_missing(rows, collection, embed)
    else:
        raise ValueError(f"unknown force mode: {force!r}")
    return kept.unionByName(added)


def _check_ids(rows: DataFrame) -> None:
    """Reads the ids only, so that nothing is embedded for the check."""
    wrong = (
        rows.groupBy("chunk_id").count().where("count > 1 or chunk_id is null").select("chunk_id").take(5)
    )
    if wrong:
        raise ValueError(f"missing or duplicate ids in one insert: {[r.chunk_id for r in wrong]}")


def add_chunks(
    spark: SparkSession,
    rows: DataFrame,
    embed: Embed,
    name: str = COLLECTION_NAME,
    force: str | None = None,
    order: list[str] | None = None,
    key: str = "chunk_id",
) -> DataFrame:
    """Insert into the collection table and return it.

    With ``order``, a unique key of ``rows`` in input order, rows without an id get
    default ids. ``key="stable_id"`` tells stored rows by that column instead, which
    doesn't change when another file comes first: such rows are left out before any
    are named, so an insert that runs again adds nothing. What is new is written down
    once and checked and embedded from there. ``"replace"`` writes the slots of the given
    ids only, each of which changes at once; run again after a failure, it ends what is
    left. Rows are sorted by id within a file and have Bloom filters of the ids, so that a
    look-up by id can skip row groups.
    """
    if force not in (None, "ignore", "replace"):
        raise ValueError(f"unknown force mode: {force!r}")
    collection = open_collection(spark, name)
    slots, buckets = _layout(spark, name)
    for column in {"stable_id", "metadata_json"}.difference(rows.columns):
        rows = rows.withColumn(column, F.lit(None).cast("string"))
    if key == "stable_id":
        rows = write_stage(new_chunks(rows, stable_index(spark, name), key), "insert")
    elif key != "chunk_id":
        raise ValueError(f"unknown key: {key!r}")
    if order and rows.where("chunk_id is null").take(1):
        rows = with_default_ids(rows, collection, order)
    rows = rows.select("chunk_id", "stable_id", "document", "metadata", "metadata_json")
    if force != "replace":
        rows = new_chunks(rows, collection)
    rows = write_stage(rows, "insert")
    _check_ids(rows)
    columns = COLLECTION.fieldNames()
    if force == "replace":
        touched = [r.slot for r in rows.select(_slot(slots)).distinct().collect()]  # at most all slots
        stored = spark.table(name).where(F.col("slot").isin(touched)).drop("slot")
        after = collection_after(rows, stored, embed, force)
        _replace_slots(after.select(*columns, _slot(slots)), name, "chunk_id", buckets, touched)
        if spark.catalog.tableExists(_index_name(name)):
            held = spark.table(name).where(F.col("slot").isin(touched))
            _replace_slots(_index_rows(held, slots), _index_name(name), "stable_id", buckets, touched)
    else:
        _write_slots(embed(rows).select(*columns, _slot(slots)), name, "chunk_id", buckets, "append")
        if spark.catalog.tableExists(_index_name(name)):
            _write_slots(_index_rows(rows, slots), _index_name(name), "stable_id", buckets, "append")
    return open_collection(spark, name)
