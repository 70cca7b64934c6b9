"""Scalar column expressions.

All of these are plain ``pyspark.sql.functions`` compositions: they stay
inside whole-stage codegen and never call back into Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_LABEL = "unknown"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_ticker(c: str | Column, default: str = UNKNOWN_LABEL) -> Column:
    """Null or blank label -> ``default``; otherwise the trimmed text."""
    return F.coalesce(F.nullif(F.trim(col(c).cast("string")), F.lit("")), F.lit(default))


def format_entity(c: str | Column) -> Column:
    """Integral numbers print without a fractional part (``17.0`` -> ``17``)."""
    x = col(c)
    return F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(x.cast("string"))


def nullif_zero(c: str | Column) -> Column:
    """``np.where(y == 0, nan, y)`` expressed as SQL NULL."""
    return F.nullif(col(c), F.lit(0))


def parse_date(c: str | Column) -> Column:
    """Lenient date parse; malformed text becomes NULL (``try_cast``)."""
    return col(c).try_cast("date")


def day_index(c: str | Column) -> Column:
    """Days since 1970-01-01 as a double (regression regressor for trends)."""
    return F.datediff(col(c), F.lit("1970-01-01").cast("date")).cast("double")


def time_index(c: str | Column, step: str = "day") -> Column:
    """Position in units of the series step: days, weeks or hours."""
    if step == "week":
        return day_index(c) / 7
    if step == "hour":
        return day_index(c) * 24 + F.hour(col(c)).cast("double")
    return day_index(c)


def add_steps(ts: str | Column, k: str | Column, step: str = "day") -> Column:
    """Move a time column forward by ``k`` steps (day / week / hour)."""
    t, n = col(ts), col(k)
    if step == "day":
        return F.date_add(t, n.cast("int"))
    if step == "week":
        return F.date_add(t, (n * 7).cast("int"))
    if step == "hour":
        return t + F.make_dt_interval(F.lit(0), n.cast("int"))
    raise ValueError(f"unknown step {step!r}; expected day, week or hour")


def pack_order_key(parts: Sequence[tuple[str | Column, int]]) -> Column:
    """Pack integer columns of declared widths into one ``decimal(38,0)`` key.

    ``parts`` is a list of ``(column, digits)``; earlier parts are more
    significant.  The packing is fixed by the declaration, so type and plan
    do not depend on the data and no pass over it is needed.  A decimal
    ordering keeps ``min_by`` / ``max_by`` on HashAggregate (a struct
    ordering falls back to SortAggregate).  NULL sorts before every value;
    a negative part or one of too many digits raises.
    """
    total = sum(d for _, d in parts)
    if total > 38:
        raise ValueError(f"order key needs {total} digits; decimal(38,0) holds 38")
    key = None
    for c, digits in parts:
        x = col(c).cast("decimal(38,0)")
        limit = F.lit(str(10 ** digits - 1)).cast("decimal(38,0)")
        fits = x.isNull() | ((x >= 0) & (x < limit))
        term = F.when(fits, F.coalesce(x + 1, F.lit(0))).otherwise(
            F.raise_error(F.concat(F.lit(f"order key part outside 0..10^{digits}-2: "), x.cast("string")))).cast("decimal(38,0)")
        key = term if key is None else (key * F.lit(str(10 ** digits)).cast("decimal(38,0)") + term).cast("decimal(38,0)")
    return key


def concat_name(*parts: str | Column, sep: str = "_") -> Column:
    """F-string style concatenation of name parts."""
    return F.concat_ws(sep, *[col(p) for p in parts])


def stable_round(c: str | Column, digits: int) -> Column:
    """Round after a nudge of half a unit three digits further down.

    Terminating decimals (means of cent values, medians, day averages) often
    sit exactly on a rounding tie, and two engines that add in a different
    order land on either side of it.  The nudge moves the tie off the
    decimal lattice, so equal values round equally; the result stays within
    one unit of the last digit.
    """
    return F.round(col(c) + F.lit(0.5 * 10.0 ** -(digits + 3)), digits)
