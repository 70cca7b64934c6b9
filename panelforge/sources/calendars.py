"""Holiday calendars as a source.

The reference asks a per-row holiday library for three calendars.  Here a
calendar is a day grid (``explode(sequence(start, end))``) equi-joined with a
small rules table on match keys:

fixed        month/day                          (H1)
nth / last   n-th or last weekday of a month    (H2)
easter       Easter Sunday + offset             (H3)
observed     Saturday -> Friday, Sunday -> Monday, named "<name> (observed)" (H4)
special      one-off closures, explicit dates   (H5)

The rules below are our own definitions taken from public law (federal
holidays) and public exchange history; they are not checked against any
holiday package.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ISO weekday numbers (Spark ``weekday`` is 0 = Monday; we add 1).
MON, TUE, WED, THU, FRI, SAT, SUN = 1, 2, 3, 4, 5, 6, 7

OBSERVED_SUFFIX = " (observed)"


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str                    # fixed | nth | last | easter | after_first_monday | date
    month: int = 0
    day: int = 0
    weekday: int = 0             # ISO 1..7
    nth: int = 0
    offset: int = 0              # easter offset in days
    first_year: int = 1
    last_year: int = 9999
    every: int = 1               # only years divisible by this
    observed: str = "none"       # none | both (Sat->Fri, Sun->Mon) | sun_only (Sun->Mon)
    date: str = ""               # for kind == "date"
    weekend_kept: bool = True    # False: a weekend date itself is not listed (exchange closures)


# US federal holidays (category "public").
US_PUBLIC = [
    Rule("New Year's Day", "fixed", 1, 1, observed="both"),
    Rule("Martin Luther King Jr. Day", "nth", 1, weekday=MON, nth=3, first_year=1986),
    Rule("Washington's Birthday", "nth", 2, weekday=MON, nth=3, first_year=1971),
    Rule("Memorial Day", "last", 5, weekday=MON, first_year=1971),
    Rule("Juneteenth National Independence Day", "fixed", 6, 19, first_year=2021, observed="both"),
    Rule("Independence Day", "fixed", 7, 4, observed="both"),
    Rule("Labor Day", "nth", 9, weekday=MON, nth=1),
    Rule("Columbus Day", "nth", 10, weekday=MON, nth=2, first_year=1971),
    Rule("Veterans Day", "nth", 10, weekday=MON, nth=4, first_year=1971, last_year=1977),
    Rule("Veterans Day", "fixed", 11, 11, first_year=1978, observed="both"),
    Rule("Thanksgiving Day", "nth", 11, weekday=THU, nth=4, first_year=1942),
    Rule("Christmas Day", "fixed", 12, 25, observed="both"),
]

# Widely celebrated US days without official observance ("unofficial").
US_UNOFFICIAL = [
    Rule("Groundhog Day", "fixed", 2, 2),
    Rule("Valentine's Day", "fixed", 2, 14),
    Rule("Saint Patrick's Day", "fixed", 3, 17),
    Rule("Halloween", "fixed", 10, 31),
    Rule("Election Day", "after_first_monday", 11, weekday=TUE, every=4),
]

# NYSE full-day closures (regular holidays and one-off closures).
NYSE = [
    Rule("New Year's Day", "fixed", 1, 1, observed="sun_only", weekend_kept=False),
    Rule("Martin Luther King Jr. Day", "nth", 1, weekday=MON, nth=3, first_year=1998),
    Rule("Washington's Birthday", "nth", 2, weekday=MON, nth=3, first_year=1971),
    Rule("Good Friday", "easter", offset=-2),
    Rule("Memorial Day", "last", 5, weekday=MON, first_year=1971),
    Rule("Juneteenth National Independence Day", "fixed", 6, 19, first_year=2022, observed="both",
         weekend_kept=False),
    Rule("Independence Day", "fixed", 7, 4, observed="both", weekend_kept=False),
    Rule("Labor Day", "nth", 9, weekday=MON, nth=1),
    Rule("Thanksgiving Day", "nth", 11, weekday=THU, nth=4, first_year=1942),
    Rule("Christmas Day", "fixed", 12, 25, observed="both", weekend_kept=False),
    Rule("Closed for Hurricane Gloria", "date", date="1985-09-27"),
    Rule("Day of Mourning for President Richard Nixon", "date", date="1994-04-27"),
    Rule("Closed for September 11 attacks", "date", date="2001-09-11"),
    Rule("Closed for September 11 attacks", "date", date="2001-09-12"),
    Rule("Closed for September 11 attacks", "date", date="2001-09-13"),
    Rule("Closed for September 11 attacks", "date", date="2001-09-14"),
    Rule("Day of Mourning for President Ronald Reagan", "date", date="2004-06-11"),
    Rule("Day of Mourning for President Gerald Ford", "date", date="2007-01-02"),
    Rule("Closed for Hurricane Sandy", "date", date="2012-10-29"),
    Rule("Closed for Hurricane Sandy", "date", date="2012-10-30"),
    Rule("Day of Mourning for President George H.W. Bush", "date", date="2018-12-05"),
    Rule("Day of Mourning for President Jimmy Carter", "date", date="2025-01-09"),
]

CALENDARS = {
    "publicHolidaysUS": US_PUBLIC,
    "unofficialHolidaysUS": US_UNOFFICIAL,
    "financialHolidaysNYSE": NYSE,
}


def iso_weekday(d: Column) -> Column:
    return F.weekday(d) + 1


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday of ``year`` (anonymous Gregorian computus, integer arithmetic)."""
    y = year.cast("int")

    def div(a: Column, b: int) -> Column:
        return F.floor(a / b).cast("int")

    a = y % 19
    b = div(y, 100)
    c = y % 100
    d = div(b, 4)
    e = b % 4
    f = div(b + 8, 25)
    g = div(b - f + 1, 3)
    h = (a * 19 + b - d - g + 15) % 30
    i = div(c, 4)
    k = c % 4
    ll = (e * 2 + i * 2 - h - k + 32) % 7
    m = div(a + h * 11 + ll * 22, 451)
    s = h + ll - m * 7 + 114
    return F.make_date(y, div(s, 31), s % 31 + 1)


# --------------------------------------------------------------------------
# Rules as data.  Every rule has one match key (e.g. ``N:11-4-4`` = 4th
# Thursday of November); every day emits the keys it satisfies for itself
# ("c") and, when an observed shift can land on it, for the day before
# ("p", Mondays) or after ("n", Fridays).  An equi-join with the broadcast
# rules table (fixed, small) finds the holidays; year ranges, weekend and
# observed policies are plain filters.  No per-rule expression is compiled.

RULES_SCHEMA = ("cal string, ord int, name string, key string, first_year int, last_year int, "
                "every int, observed string, kept boolean")


def rule_key(rule: Rule) -> str:
    if rule.kind == "fixed":
        return f"F:{rule.month}-{rule.day}"
    if rule.kind == "nth":
        return f"N:{rule.month}-{rule.weekday}-{rule.nth}"
    if rule.kind == "last":
        return f"L:{rule.month}-{rule.weekday}"
    if rule.kind == "after_first_monday":
        return f"A:{rule.month}-{rule.weekday}"
    if rule.kind == "easter":
        return f"E:{rule.offset}"
    if rule.kind == "date":
        return f"D:{rule.date}"
    raise ValueError(f"unknown rule kind {rule.kind!r}")


def rules_frame(spark, calendars: dict | None = None) -> DataFrame:
    """One row per rule (calendar, position, name, match key, policies)."""
    rows = [(cal, i, r.name, rule_key(r), r.first_year, r.last_year, r.every, r.observed, r.weekend_kept)
            for cal, rules in (calendars or CALENDARS).items() for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def _day_keys(d: Column, tag: str) -> Column:
    """Structs (tag, year, key) for every rule shape date ``d`` satisfies."""
    y, m, dd, w = F.year(d), F.month(d), F.dayofmonth(d), iso_weekday(d)
    last_week = F.month(F.date_add(d, 7)) != m

    def k(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    keys = [k("F:", m, "-", dd), k("N:", m, "-", w, "-", F.ceil(dd / 7).cast("int")),
            F.when(last_week, k("L:", m, "-", w)), F.when(dd.between(2, 8), k("A:", m, "-", w)),
            k("E:", F.datediff(d, easter_sunday(y))), k("D:", d.cast("string"))]
    return F.array(*[F.struct(F.lit(tag).alias("tag"), y.alias("year"), key.alias("key")) for key in keys])


def holiday_calendar(start: Column | str, end: Column | str, calendars: dict | None = None,
                     time: str = "timestamp", spark=None, closures: DataFrame | None = None) -> DataFrame:
    """One row per date that is a holiday in at least one calendar.

    H5: ``closures`` (``cal, date, name, source`` and optionally ``valid_from, valid_to``, the span in
    which an entry counts) adds one-off closures of the user's own; each needs a source.  They are joined
    by date, so the table may be of any size, and named behind the rules of their calendar, by name.

    ``start``/``end`` are literal dates or columns (e.g. scalar sub-queries
    over the data).  The day grid is bounded by the span; the result holds a
    few rows per year and can be broadcast.
    """
    cals = calendars or CALENDARS
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
    lo = F.lit(start).cast("date") if isinstance(start, str) else start
    hi = F.lit(end).cast("date") if isinstance(end, str) else end
    days = spark.range(1).select(F.explode(F.sequence(lo, hi)).alias(time))
    t = F.col(time)
    wd = iso_weekday(t)
    keys = F.concat(_day_keys(t, "c"),
                    F.when(wd == MON, _day_keys(F.date_sub(t, 1), "p")).otherwise(F.array()),
                    F.when(wd == FRI, _day_keys(F.date_add(t, 1), "n")).otherwise(F.array()))
    cand = days.select(time, wd.alias("_w"), F.explode(keys).alias("k")).where(F.col("k.key").isNotNull())
    rules = rules_frame(spark, cals)
    hit = cand.join(F.broadcast(rules), cand["k.key"] == rules["key"])
    yr = F.col("k.year")
    in_years = yr.between(F.col("first_year"), F.col("last_year")) & (yr % F.col("every") == 0)
    tag = F.col("k.tag")
    named = (hit.where(in_years)
             .select(time, "cal", "ord",
                     F.when((tag == "c") & (F.col("kept") | (F.col("_w") <= FRI)), F.col("name"))
                     .when((tag == "p") & F.col("observed").isin("both", "sun_only"),
                           F.concat(F.col("name"), F.lit(OBSERVED_SUFFIX)))
                     .when((tag == "n") & (F.col("observed") == "both"),
                           F.concat(F.col("name"), F.lit(OBSERVED_SUFFIX))).alias("label"))
             .where(F.col("label").isNotNull()))
    if closures is not None:
        day = F.col("date").cast("date")
        own = closures.where(day.between(lo, hi) & F.col("cal").isin(list(cals)))
        if "valid_from" in closures.columns:
            own = own.where(F.col("valid_from").isNull() | (day >= F.col("valid_from").cast("date")))
        if "valid_to" in closures.columns:
            own = own.where(F.col("valid_to").isNull() | (day <= F.col("valid_to").cast("date")))
        no_source = F.raise_error(F.concat(F.lit("closure without a source: "), day.cast("string")))
        label = F.when(F.coalesce(F.trim("source"), F.lit("")) == "", no_source.cast("string")).otherwise(F.col("name"))
        named = named.unionByName(own.select(day.alias(time), "cal", F.lit(1 << 30).alias("ord"), label.alias("label")))
    # One aggregation per day (a handful of names); the calendars are split
    # out of the sorted list with array functions, in rule order.
    per_day = named.groupBy(time).agg(F.array_sort(F.collect_list(F.struct("cal", "ord", "label"))).alias("_l"))

    def names(c: str) -> Column:
        picked = F.transform(F.filter("_l", lambda x: x["cal"] == c), lambda x: x["label"])
        return F.nullif(F.array_join(picked, "; "), F.lit("")).alias(c)

    return per_day.select(time, *[names(c) for c in cals])
