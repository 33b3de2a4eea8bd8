"""Numbering rows in a global order without sorting them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.shared import checkpoint


def running_start(rows: DataFrame, order: list[str], value: str) -> DataFrame:
    """Add ``running_start``: the sum of ``value`` over all rows before, by ``order``.

    ``rows`` should hold only keys and the value. It is range-partitioned and
    checkpointed, since the range bounds come from a sample and must be the same
    for the sums and for the rows. What is summed in one task is a single row per
    partition.
    """
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = checkpoint(
        rows.repartitionByRange(partitions, *order).withColumn("part", F.spark_partition_id())
    )
    earlier_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("part")
        .agg(F.sum(value).alias("in_part"))
        .select("part", F.coalesce(F.sum("in_part").over(earlier_parts), F.lit(0)).alias("part_start"))
    )
    earlier_rows = (
        Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    within = F.coalesce(F.sum(value).over(earlier_rows), F.lit(0))
    # at most one row per shuffle partition
    return (
        ranged.withColumn("within", within)
        .join(F.broadcast(starts), "part")
        .select(*rows.columns, (F.col("within") + F.col("part_start")).alias("running_start"))
    )
