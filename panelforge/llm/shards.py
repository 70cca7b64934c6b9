"""Contiguous, byte-balanced shards from global prefix sums (operator 3), DataFrame functions only.

Method: rows (ids and sizes, not texts) are range-partitioned by id and numbered in
their partition; the totals of the partitions (one row each) are summed to offsets,
which turn the running sums in a partition into global ones.  A row whose middle
byte lies in the k-th of ``n_shards`` equal parts of the corpus goes to shard k.
Each shard's bytes differ from the target by less than the largest row.

Defined results: a null text counts no bytes (its crc32 is that of the empty text).
Rows of one id, null ids first, are ordered by crc and size; full repeats take
neighbouring slots.  An empty table gives no row.  Output has only the columns
named here and those in ``keep``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written


def byte_shards(docs: DataFrame, n_shards: int = 24, key: str = "doc_id", text: str = "text",
                overhead: int = 8, keep: tuple[str, ...] = ()) -> DataFrame:
    """key, keep, size, text_crc32, global_start, shard, slot."""
    utf8 = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = docs.select(key, *[c for c in keep if c != key], (F.octet_length(utf8) + overhead).cast("long").alias("size"),
                       F.crc32(utf8).alias("text_crc32"))
    order = [F.asc_nulls_first(key), "text_crc32", "size"]
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Written, so that a lost executor cannot change which rows a partition number stands for.
    ranged = written(rows.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "shards")
    totals = ranged.groupBy("__part").agg(F.sum("size").alias("__bytes"), F.count("*").alias("__rows"))
    # One row for each partition: a bounded table, whatever the input.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    offsets = written(totals.select("__part", F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__byte0"),
                                    F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__row0"),
                                    F.sum("__bytes").over(every).alias("__total")), "shard-offsets")
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (ranged.withColumns({"__upto": F.sum("size").over(inside), "__nth": F.count("*").over(inside)})
              .join(F.broadcast(offsets), "__part")
              .withColumn("global_start", F.col("__byte0") + F.col("__upto") - F.col("size"))
              .withColumn("__row", F.col("__row0") + F.col("__nth") - 1)
              .withColumn("shard", F.expr(f"CAST(least({n_shards - 1}, (2 * CAST(global_start AS decimal(38,0)) + size) "
                                          f"* {n_shards} div (2 * CAST(__total AS decimal(38,0)))) AS int)")))
    placed = written(placed.drop("__byte0", "__row0", "__total", "__upto", "__nth", "__part"), "shards-placed")
    first = placed.groupBy("shard").agg(F.min("__row").alias("__first"))  # at most n_shards rows
    return (placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("__row") - F.col("__first"))
            .select(key, *[c for c in keep if c != key], "size", "text_crc32", "global_start", "shard", "slot"))
