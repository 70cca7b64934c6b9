"""As-of joins by validity intervals: mixed frequencies on one calendar.

An observation is valid from its release to the next release of its series.  The intervals come
from range partitions, so one long series spreads over many tasks; the join is an equi-join on
(series, stretch of time) and needs neither a nested loop nor a window over a whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def validity_intervals(obs: DataFrame, keys: Sequence[str], available: str, value: str, order: str | None = None,
                       partitions: int | None = None) -> DataFrame:
    """``keys, _from, _until, value``: each release with the release that follows it (NULL for the last).

    Of several observations released at once the last by ``order`` (a number or date; default: the
    largest value) counts.  Rows are dealt into ranges of (keys, release) and written to the checkpoint
    folder; inside a range the next row is the next release, and a range's last row takes the first row
    of the next range that has any: one boundary row a range.
    """
    spark = obs.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = obs.where(F.col(available).isNotNull())
    for k in keys:
        given = given.where(F.col(k).isNotNull())
    pick = F.max_by(value, order) if order else F.max(value)
    one = given.groupBy(*keys, F.col(available).alias("_from")).agg(pick.alias("_v"))
    ranged = (one.repartitionByRange(n, *keys, "_from").withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    here = Window.partitionBy("_pid").orderBy(*keys, "_from")
    this = F.struct(*keys, "_from")
    # One row a range, ordered by range: the bound is the number of partitions.
    heads = ranged.withColumn("_rn", F.row_number().over(here)).where(F.col("_rn") == 1).select("_pid", this.alias("_head"))
    follow = heads.select("_pid", F.lead("_head").over(Window.orderBy("_pid")).alias("_after"))
    rows = (ranged.withColumn("_next", F.lead(this).over(here)).join(F.broadcast(follow), "_pid")
            .withColumn("_next", F.coalesce("_next", "_after")))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"_next.{k}") == F.col(k))
    return rows.select(*keys, "_from", F.when(same, F.col("_next._from")).alias("_until"), F.col("_v").alias(value))


def _stretch(t: Column, days: int) -> Column:
    return F.floor(F.datediff(t, F.lit("1970-01-01").cast("date")) / days).cast("int")


def asof_join(left: DataFrame, obs: DataFrame, keys: Sequence[str], time: str, available: str, value: str,
              order: str | None = None, out: str | None = None, days: int = 32, partitions: int | None = None) -> DataFrame:
    """Every row of ``left`` with the latest value of its series released by ``time`` (NULL before the first).

    Intervals are laid over stretches of ``days`` days that ``left`` spans, so a row meets exactly one
    interval of its series in its own stretch.  A value that is NULL is carried like any other.
    """
    out = out or value
    lo, hi = left.agg(F.min(time), F.max(time)).first()  # one row: the span of the calendar
    iv = validity_intervals(obs, keys, available, value, order, partitions)
    kind = left.schema[time].dataType
    first, last = F.lit(lo).cast(kind), F.lit(hi).cast(kind)
    iv = (iv.where((F.col("_from") <= last) & (F.col("_until").isNull() | (F.col("_until") > first)))
          .withColumn("_s", F.explode(F.sequence(_stretch(F.greatest("_from", first), days), _stretch(F.least(F.coalesce("_until", last), last), days))))
          .select(*[F.col(k).alias(f"_k{j}") for j, k in enumerate(keys)], "_s", "_from", "_until", F.col(value).alias("_value")))
    rows = left.withColumn("_stretch", _stretch(F.col(time), days))
    match = (F.col("_stretch") == F.col("_s")) & (F.col(time) >= F.col("_from")) & (F.col("_until").isNull() | (F.col(time) < F.col("_until")))
    for j, k in enumerate(keys):
        match = match & (F.col(k) == F.col(f"_k{j}"))
    return rows.join(iv, match, "left").select(*[F.col(c) for c in left.columns if c != out], F.col("_value").alias(out))


# --------------------------------------------------------------- release calendars

#: Days from the end of a period to its release, by frequency.
RELEASE_LAG = {"weekly": 5, "monthly": 15, "quarterly": 30}


def period_end(day: Column, frequency: str) -> Column:
    """Last day of the period that holds ``day``: weeks end on Friday."""
    if frequency == "weekly":
        return F.next_day(F.date_sub(day, 1), "FRI")
    if frequency == "monthly":
        return F.last_day(day)
    if frequency == "quarterly":
        return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))
    raise ValueError(f"unknown frequency {frequency!r}")


def by_frequency(day: Column, frequencies: Sequence[str] = tuple(RELEASE_LAG)) -> Column:
    """One row a frequency: (frequency, end of the day's period, its release)."""
    return F.explode(F.array(*[F.struct(F.lit(f).alias("frequency"), period_end(day, f).alias("period_end"),
                                        F.date_add(period_end(day, f), RELEASE_LAG[f]).alias("available")) for f in frequencies]))
