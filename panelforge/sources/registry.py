"""Dataset registry and macro-series catalog.

The reference declares its datasets in YAML that no code loads (and that is
not valid YAML).  Here the registry is plain Python: a spec names the
table, the variables, the key and date columns, optional date bounds,
IN-list filters and header tables to enrich from.  ``load`` turns a spec
into ONE scan (pruned to the variables, filters pushed to Parquet) plus the
header joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import read_table


@dataclass(frozen=True)
class HeaderJoin:
    """Left join a header table on ``left_key = right_key`` to add ``columns``."""
    table: str
    left_key: str
    right_key: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    table: str
    variables: tuple[str, ...]
    keyvar: str
    datevar: str
    start: str | None = None
    end: str | None = None
    filters: Mapping[str, tuple] = field(default_factory=dict)
    headers: tuple[HeaderJoin, ...] = ()
    date_kind: str = "date"


# The datasets of the provided test tables.
REGISTRY: dict[str, DatasetSpec] = {
    "orders_enriched": DatasetSpec(
        name="orders_enriched", table="orders",
        variables=("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus",
                   "o_orderpriority"),
        keyvar="o_orderkey", datevar="o_orderdate", start="1992-01-01", end="2024-12-31",
        filters={"o_orderpriority": ("1-URGENT", "2-HIGH")},
        headers=(HeaderJoin("customer", "o_custkey", "c_custkey", ("c_nationkey", "c_mktsegment")),
                 HeaderJoin("nation", "c_nationkey", "n_nationkey", ("n_name",)))),
    "security_lines": DatasetSpec(
        name="security_lines", table="lineitem",
        variables=("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice",
                   "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"),
        keyvar="l_suppkey", datevar="l_shipdate",
        headers=(HeaderJoin("supplier", "l_suppkey", "s_suppkey", ("s_nationkey",)),)),
}


def load(spark: SparkSession, sf_dir: str, spec: DatasetSpec | str, columns: Sequence[str] | None = None,
         start: str | None = None, end: str | None = None,
         filters: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Scan + select + date bounds + IN filters + header joins."""
    s = REGISTRY[spec] if isinstance(spec, str) else spec
    cols = list(columns or s.variables)
    for c in (s.keyvar, s.datevar):
        if c not in cols:
            cols.append(c)
    asked = list(cols)
    joined = {c for h in s.headers for c in h.columns}  # a later header may join on an earlier one's column
    for c in (*s.filters, *(filters or {}), *(h.left_key for h in s.headers)):  # read, but not returned unless asked for
        if c not in cols and c not in joined:
            cols.append(c)
    df = read_table(spark, sf_dir, s.table, cols)
    lo, hi = start or s.start, end or s.end
    if s.date_kind == "date":
        df = df.withColumn(s.datevar, F.to_date(s.datevar))
    if lo is not None:
        df = df.where(F.col(s.datevar) >= F.lit(lo).cast("date"))
    if hi is not None:
        df = df.where(F.col(s.datevar) <= F.lit(hi).cast("date"))
    for var, values in {**dict(s.filters), **dict(filters or {})}.items():
        df = df.where(F.col(var).isin(list(values)))
    for h in s.headers:
        hdr = read_table(spark, sf_dir, h.table, [h.right_key, *h.columns])
        df = df.join(hdr, df[h.left_key] == hdr[h.right_key], "left").drop(hdr[h.right_key])
    return df.drop(*[c for c in cols if c not in asked]) if columns else df


# --------------------------------------------------------------- macro catalog


CATALOG_COLUMNS = ["name", "id", "units", "seasonal_adjustment", "frequency", "source"]


def series_catalog(spark: SparkSession, entries: Sequence[Mapping[str, str]]) -> DataFrame:
    """The macro-series catalog as a small dimension table."""
    rows = [tuple(e.get(c) for c in CATALOG_COLUMNS) for e in entries]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CATALOG_COLUMNS))


def macro_series(observations: DataFrame, catalog: DataFrame, frequency: str | None = None,
                 key: str = "series_id") -> DataFrame:
    """Long macro observations joined to their catalog rows, filtered by frequency.

    The catalog holds one row per declared series (a fixed, small list), so
    it is broadcast.
    """
    cat = catalog if frequency is None else catalog.where(F.lower("frequency") == frequency.lower())
    cat = cat.select(F.col("id").alias(key), "name", "units", "frequency")
    return observations.join(F.broadcast(cat), key, "inner")
