"""Tables written to the folder all executors share.

A stage that several later reads depend on is written once as Parquet, so that
an executor lost later costs a re-read of a file, not the whole lineage, and so
that each reader scans only the columns it needs.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode."""
    sc = spark.sparkContext
    configured = spark.conf.get(_CONF, None) or sc.getConf().get(_CONF)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError(f"set {_CONF} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="docloom-")
    sc.setCheckpointDir(folder)
    return folder


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under a fresh name in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stages/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def write_buckets(df: DataFrame, name: str, key: str, *order: str) -> DataFrame:
    """``write_stage`` in buckets of ``key``: joins and windows on it move nothing.

    The table is entered in the catalog under a fresh name, since buckets are known
    for tables only.
    """
    spark = df.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fresh = f"{name}_{uuid.uuid4().hex}"
    buckets = df.repartition(count, key).write.format("parquet").bucketBy(count, key).sortBy(key, *order)
    buckets.option("path", f"{shared_dir(spark).rstrip('/')}/stages/{fresh}").saveAsTable(fresh)
    return spark.table(fresh)


def spread(df: DataFrame) -> DataFrame:
    """Spread a test table over all cores: a file of one row group is one task. With files for
    all cores nothing moves."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a narrow table."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
