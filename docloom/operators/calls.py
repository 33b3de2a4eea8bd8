"""Calls of a paid or slow function that are made once for each text, whatever fails.

What a call returned is kept in a folder of Parquet files under the hash of the text and of
the function's version. Texts are looked up there first; only those without a result are
called, each distinct text once, in tasks of bounded size. A task's results are in place as
soon as that task commits, not when the job ends, so a job that is killed leaves all that
its finished tasks paid for, and running it again calls the rest only. A task that two
attempts committed leaves a result twice, which is read once.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docloom.shared import write_stage

# Keys of this many texts at most are broadcast to the stored results.
BROADCAST_KEYS = 1 << 18


@dataclass(frozen=True)
class Retry:
    """How often a call is tried, and the seconds between: ``wait``, doubled each time up to
    ``most``, times a random number from 0.5 to 1, so that tasks don't come back together."""

    tries: int = 1
    wait: float = 1.0
    most: float = 60.0

    def __call__(self, call: Callable[[], Any]) -> Any:
        for left in range(self.tries - 1, -1, -1):
            try:
                return call()
            except Exception:
                if not left:
                    raise
                pause = min(self.most, self.wait * 2.0 ** (self.tries - 1 - left))
                time.sleep(pause * random.uniform(0.5, 1.0))


@dataclass(frozen=True)
class Memory:
    """Where results are kept. Another ``version`` of the function has results of its own."""

    folder: str
    version: str = ""
    #: About how many texts a task calls before its results are in place.
    task_texts: int = 1024

    def key(self, text: str) -> Column:
        return F.sha2(F.concat(F.lit(self.version), F.lit("\0"), F.col(text)), 256)

    def stored(self, spark: SparkSession, result: T.DataType) -> DataFrame:
        """(key, result) of all calls so far; a key may come twice."""
        schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("result", result)])
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.folder)


Call = Callable[[list[str]], list]


def each(call: Call, texts: list[str], retry: Retry) -> list:
    """Results of a call for many texts. If it fails for good, each text is called alone; a
    text that still fails has None."""

    def checked(some: list[str]) -> list:
        found = list(call(some))
        if len(found) != len(some):
            raise ValueError("not one result for each text")
        return found

    try:
        return retry(partial(checked, texts))
    except Exception:
        if len(texts) == 1:
            return [None]
        return [each(call, [text], retry)[0] for text in texts]


def _called(
    batches: Iterator[pa.RecordBatch], call: Call, call_size: int, retry: Retry, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, call_size):
            part = batch.slice(begin, call_size)
            rows = zip(part.column("key").to_pylist(), each(call, part.column("text").to_pylist(), retry))
            done = [{"key": key, "result": result} for key, result in rows if result is not None]
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)


def _held(memory: Memory, keys: DataFrame, few: bool, result: T.DataType) -> DataFrame:
    """Stored results, of few keys only theirs, which then don't move."""
    stored = memory.stored(keys.sparkSession, result)
    return stored.join(F.broadcast(keys), "key", "left_semi") if few else stored


def _todo(known: DataFrame, text: str, missing: DataFrame, count: int, tasks: int) -> DataFrame:
    """(key, text) of the missing keys, each once, dealt out into so many tasks.

    The texts of few keys are picked where they lie; of many, all texts move, and only once.
    """
    texts = known.select(F.col("call_key").alias("key"), F.col(text).alias("text"))
    if count <= BROADCAST_KEYS:
        picked = texts.join(F.broadcast(missing), "key", "left_semi").dropDuplicates(["key"])
        return picked.repartition(tasks)
    dealt = texts.repartition(tasks, "key").join(missing.repartition(tasks, "key"), "key", "left_semi")
    return dealt.dropDuplicates(["key"])


def remembered(
    rows: DataFrame,
    text: str,
    call: Call,
    result: T.DataType,
    memory: Memory,
    call_size: int = 1,
    retry: Retry = Retry(),
) -> DataFrame:
    """Add a column ``result``: what ``call`` returns for the text, from memory if it can be.

    A null text, and one for which every try failed, has null; the latter isn't remembered.
    ``rows`` are read several times and should be a table that is written down. The results
    are read from the memory's folder whenever the returned table is; later ones don't show.
    """
    keyed = rows.withColumn("call_key", memory.key(text))
    known = keyed.where(F.col("call_key").isNotNull())
    keys = write_stage(known.select(F.col("call_key").alias("key")).distinct(), "call-keys")
    few = keys.count() <= BROADCAST_KEYS
    missing = keys.join(_held(memory, keys, few, result).select("key"), "key", "left_anti")
    missing = write_stage(missing, "calls")
    count = missing.count()
    if count:
        schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("result", result)])
        run = partial(
            _called, call=call, call_size=call_size, retry=retry, schema=to_arrow_schema(schema)
        )
        (
            _todo(known, text, missing, count, -(-count // memory.task_texts))
            .mapInArrow(run, schema)
            .write.mode("append")
            # tasks move their files to the folder when they commit
            .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            .parquet(memory.folder)
        )
    held = _held(memory, keys, few, result).dropDuplicates(["key"])
    return keyed.join(held.withColumnRenamed("key", "call_key"), "call_key", "left").drop("call_key")
