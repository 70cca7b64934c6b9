"""Distributed dense ordinal of the distinct values of a key.

``row_number() over (order by k)`` without a partition moves every row into
one task.  Here the distinct keys are range-partitioned, numbered inside each
range, and offset by the running count of the preceding ranges (a table with
one row per partition, so its size is bounded by the partition count).
The ranged keys are checkpointed once so both passes see the same partitions,
even if an executor is lost and a stage is recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def ordinal_index(df: DataFrame, key: str, out: str = "idx", partitions: int | None = None) -> DataFrame:
    """``key, idx`` with ``idx`` = 0-based position of ``key`` in ascending order."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.where(F.col(key).isNotNull()).select(key).distinct()
    ranged = (keys.repartitionByRange(n, key)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    local = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(key)))
    # ``offsets`` has one row per range partition: a bounded broadcast.
    return (local.join(F.broadcast(offsets), "_pid")
            .select(key, (F.col("_off") + F.col("_rn") - 1).cast("bigint").alias(out)))


def row_groups(df: DataFrame, key: str, budget: int, out: str = "group", partitions: int | None = None) -> DataFrame:
    """``key, group`` with consecutive sorted keys in groups of about ``budget`` rows.

    A key goes to the group in which its first row falls when all rows stand in key order, so a group
    holds less than ``budget`` rows and its last key.  Row counts are summed per key with partial
    aggregation, range-partitioned, summed inside each range and offset by the ranges before.
    """
    if budget < 1:
        raise ValueError("budget must be >= 1")
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    ranged = sizes.repartitionByRange(n, key).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = ranged.groupBy("_pid").agg(F.sum("_n").alias("_s")).select("_pid", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"))
    here = Window.partitionBy("_pid").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_at", F.coalesce(F.sum("_n").over(here), F.lit(0)))
    return (local.join(F.broadcast(offsets), "_pid")
            .select(key, F.floor((F.col("_off") + F.col("_at")) / budget).cast("bigint").alias(out)))


def batch_groups(df: DataFrame, key: str, batch_size: int, out: str = "group") -> DataFrame:
    """``key, group`` with consecutive batches of ``batch_size`` sorted keys."""
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")
    idx = ordinal_index(df, key)
    return idx.select(key, F.floor(F.col("idx") / batch_size).cast("bigint").alias(out))
