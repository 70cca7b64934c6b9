"""Ingest hygiene: headers, required columns, projection, time parsing, checks.

SURVEY 2.2 (P1-P9), 2.3 (F1, F8, F9), 2.5 (A6).  Checks that need counts
run as ONE aggregation pass (``validate_panel``); the in-line variant of the
time check (``parse_time(..., on_error="raise")``) costs no extra pass: the
job fails at the first malformed value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import parse_date

# The raw security-panel columns and their order after projection.
RAW_PANEL_COLUMNS = ["ticker", "permco", "dlycaldt", "dlyprc", "dlycap", "dlyret",
                     "dlyvol", "shrout", "sprtrn"]
LONG_PANEL_ORDER = ["id", "timestamp", "permco", "ticker", "dlyprc", "dlyret", "dlycap",
                    "dlyvol", "shrout", "sprtrn"]
PANEL_FIELDS = ["dlyprc", "dlyret", "dlycap", "dlyvol", "shrout", "sprtrn"]


def normalise_headers(df: DataFrame) -> DataFrame:
    """Trim and lower-case every column name (``' Ticker '`` -> ``ticker``)."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail before planning anything when a required column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise KeyError(f"Missing columns in input: {missing}")
    return df


def to_long_panel(df: DataFrame, keep: Sequence[str] = RAW_PANEL_COLUMNS,
                  date_col: str = "dlycaldt", extra: Sequence[str] = ()) -> DataFrame:
    """Project, rename the date column to ``timestamp``, add ``id = 1``, reorder."""
    require_columns(df, list(keep) + list(extra))
    renamed = df.select(*keep, *extra).withColumnRenamed(date_col, "timestamp")
    order = [c for c in LONG_PANEL_ORDER if c in renamed.columns or c == "id"]
    rest = [c for c in renamed.columns if c not in order]
    return renamed.withColumn("id", F.lit(1)).select(*order, *rest)


def parse_time(df: DataFrame, column: str = "timestamp", kind: str = "date",
               on_error: str = "null") -> DataFrame:
    """Parse text to a date (or ``timestamp_ntz``).

    ``on_error="null"`` keeps malformed values as NULL (coerce);
    ``"raise"`` fails the job at the first malformed, non-null value.
    """
    raw = F.col(column)
    parsed = parse_date(raw) if kind == "date" else raw.try_cast("timestamp_ntz")
    if on_error == "raise":
        parsed = F.when(parsed.isNull() & raw.isNotNull(),
                        F.raise_error(F.concat(F.lit("invalid timestamp: "), raw.cast("string")))
                        ).otherwise(parsed)
    elif on_error != "null":
        raise ValueError("on_error must be 'null' or 'raise'")
    return df.withColumn(column, parsed)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows with a NULL key vanish (pandas group-by semantics)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def check_counts(df: DataFrame, keys: Sequence[str], time_col: str = "timestamp",
                 raw_time_col: str | None = None) -> DataFrame:
    """A6/F8/F9 in one pass: one row of counts.

    ``n_rows``, ``n_null_keys`` (any key NULL), ``n_bad_timestamps`` (text
    present but unparseable, or NULL time), ``n_duplicate_keys`` (rows beyond
    the first of each non-null key, like ``duplicated().sum()``),
    ``n_duplicate_groups``.
    """
    key_null = None
    for k in keys:
        c = F.col(k).isNull()
        key_null = c if key_null is None else key_null | c
    if raw_time_col is not None:
        bad = F.col(raw_time_col).isNull() | parse_date(F.col(raw_time_col)).isNull()
    else:
        bad = F.col(time_col).isNull()
    flagged = df.select(*keys, key_null.alias("_knull"), bad.alias("_bad"))
    # Partial aggregation per key first: a hot key costs one row per task.
    per_key = (flagged.groupBy(*keys)
               .agg(F.count(F.lit(1)).alias("_rows"),
                    F.count_if(~F.col("_knull")).alias("_n"),
                    F.count_if("_knull").alias("_nk"),
                    F.count_if("_bad").alias("_nb")))
    return per_key.agg(
        F.sum("_rows").alias("n_rows"),
        F.sum("_nk").alias("n_null_keys"),
        F.sum("_nb").alias("n_bad_timestamps"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).cast("bigint")
        .alias("n_duplicate_keys"),
        F.count_if(F.col("_n") > 1).alias("n_duplicate_groups"),
    )


def validate_panel(df: DataFrame, keys: Sequence[str], time_col: str = "timestamp",
                   raw_time_col: str | None = None, allow_duplicates: bool = True) -> dict:
    """Run ``check_counts`` and raise with the counts."""
    row = check_counts(df, keys, time_col, raw_time_col).first()
    out = row.asDict()
    if out["n_bad_timestamps"]:
        raise ValueError(f"{out['n_bad_timestamps']} of {out['n_rows']} rows have no readable date in {raw_time_col or time_col}")
    if not allow_duplicates and out["n_duplicate_keys"]:
        raise ValueError(f"{out['n_duplicate_keys']} rows repeat an earlier key")
    return out


def any_not_null(fields: Sequence[str]) -> Column:
    """True when at least one of ``fields`` holds a value."""
    cond = None
    for f in fields:
        c = F.col(f).isNotNull()
        cond = c if cond is None else cond | c
    return cond
