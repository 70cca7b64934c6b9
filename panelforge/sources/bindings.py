"""Bindings of the panel data model to the provided test tables.

B1  security panel   lineitem  -> raw long panel shaped like the CSV input
B2  short series     events    -> daily series per user (target + covariates)
B3  long history     orders x customer -> daily series per nation
B4  calendar span    derived from the orders date range

Every binding reads the given tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import pack_order_key
from .files import read_table

# Fixed values of the bindings (they define the fixtures, see FIXTURES.md).
SELECTED_ENTITIES = [1, 2, 3, 5, 8]
B2_CONTEXT_END = "2024-01-23"
B2_TEST_START, B2_TEST_END = "2024-01-24", "2024-01-30"
B2_HORIZON = 7
B2_SEASON = 7
PLOT_IDS = [7]
B3_WINDOWS = {
    "context": ("1995-01-01", "1999-12-31"),
    "validation": ("2000-01-01", "2000-12-31"),
    "test": ("2001-01-01", "2001-12-31"),
}
B3_HORIZON = 30


def security_panel_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: raw long security panel with text dates, as a CSV export would hold it.

    Columns ``ticker, permco, dlycaldt, dlyprc, dlycap, dlyret, dlyvol,
    shrout, sprtrn, ord``.  ``ord`` stands in for the input row order
    (order key, line number, part key); ``sprtrn`` is the market-wide mean
    return of the day repeated on every row of that day (Q14).
    """
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"])
    # Input order stand-in: order key, line number, part key.
    ord_key = pack_order_key([("l_orderkey", 14), ("l_linenumber", 4), ("l_partkey", 13)])
    base = li.select(
        F.when(F.col("l_returnflag") != "R", F.concat("l_returnflag", "l_linestatus")).alias("ticker"),
        F.col("l_suppkey").alias("permco"),
        F.to_date("l_shipdate").alias("_day"),
        F.col("l_extendedprice").alias("dlyprc"),
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("dlycap"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("dlyret"),
        F.col("l_quantity").alias("dlyvol"),
        F.col("l_tax").alias("shrout"),
        ord_key.alias("ord"),
    )
    # One row per calendar day: size is bounded by the date span, not by rows.
    market = base.groupBy("_day").agg(F.avg("dlyret").alias("sprtrn"))
    return base.join(F.broadcast(market), "_day", "left").select(
        "ticker", "permco", F.date_format("_day", "yyyy-MM-dd").alias("dlycaldt"),
        "dlyprc", "dlycap", "dlyret", "dlyvol", "shrout", "sprtrn", "ord")


#: Panel datasets by the name a query spec gives.
PANELS = {"security_lines": security_panel_raw}


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 (observed days only): ``id, timestamp, y, x, z`` per user and day.

    ``y`` = sum of event values (target), ``x`` = number of events and
    ``z`` = number of click events (covariates).  The raw events are
    combined map-side before the shuffle, so a hot user costs one partial
    row per task.
    """
    ev = read_table(spark, sf_dir, "events", ["user_id", "ts", "event_type", "value"])
    return (ev.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
            .groupBy(F.col("user_id").alias("id"), F.to_date("ts").alias("timestamp"))
            .agg(F.round(F.sum("value"), 6).alias("y"),
                 F.count(F.lit(1)).cast("double").alias("x"),
                 F.count_if(F.col("event_type") == "click").cast("double").alias("z")))


def hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, timestamp, y``: event value per event type and hour (observed hours only)."""
    ev = read_table(spark, sf_dir, "events", ["event_type", "ts", "value"])
    return (ev.where(F.col("event_type").isNotNull() & F.col("ts").isNotNull())
            .groupBy(F.col("event_type").alias("id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"))
            .agg(F.round(F.sum("value"), 6).alias("y")))


def nation_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 (observed days only): ``id, timestamp, y`` = order value per nation and day."""
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate", "o_totalprice"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .groupBy(F.col("c_nationkey").cast("bigint").alias("id"),
                     F.to_date("o_orderdate").alias("timestamp"))
            .agg(F.round(F.sum("o_totalprice"), 2).alias("y")))


def order_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row ``start, end`` with the order date range (drives the calendars)."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderdate"])
    return orders.agg(F.to_date(F.min("o_orderdate")).alias("start"),
                      F.to_date(F.max("o_orderdate")).alias("end"))
