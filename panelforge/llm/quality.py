"""Quality rules with adaptive thresholds (operator 2), DataFrame functions only.

Method: every measure is an integer ratio.  A mergeable quantile sketch of a group
is the table of counts of its values rounded down to ``BITS`` significant bits
(relative error at most 2**(1-BITS)); sketches of groups merge by adding counts,
so the language and corpus sketches come from the (language, source) ones without
another pass over the texts.  A measure's own fence in a group is its median plus
``reach`` times its spread plus ``margin`` (and the same downwards where the rule is
two-sided).  The spread is read off the sketch: the interquartile range, or, for
measures that are 0 in most documents and so have quartiles of 0, the mean
distance of the values from the median.  ``margin`` is a guard where all values of a group are equal.

No size switches between levels: a language's fence is the mean of its own, weighted
by its number of documents, and the corpus', weighted by ``PRIOR``; a source's is
the same mean of its own and its language's.  The fences are joined to the documents,
and a document outside any is rejected.

Defined results: a null or empty text has no words and fails the base rules.  Null
``lang`` or ``source`` are groups of their own.  Repeated rows are judged alike; a value
equal to a fence is inside it.  Very long texts are measured whole, in time n log n.
Tables with no row give no row.  Columns of the input that have the name of an
output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

BITS = 6
#: measure: (numerator, denominator, scale, spread, reach, margin, two-sided)
RULES = {
    "mean_word": ("word_chars", "n_words", 1000, "quartiles", 5, 100, True),
    "symbols": ("n_symbols", "word_chars", 10000, "deviation", 2, 50, False),
    "dup_lines": ("n_dup_lines", "n_lines", 10000, "deviation", 80, 100, False),
    "repeats": ("n_repeat_words", "n_words", 10000, "deviation", 40, 100, False),
}
#: Documents that the wider group's fence counts for in a narrower group's.
PRIOR = 200
#: Fence tables up to this many rows (some 100 bytes each) are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 50_000
STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_SPACE = r"[\x20\x09-\x0D]+"


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the integer counts of ``STATS`` and ``base_failed`` to each row.

    Windows of three words are compared by 64-bit hash within one text.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(t, F.lit(" \t\n\x0b\x0c\r"))
    df = docs.drop(*[c for c in (*STATS, "base_failed", "__words", "__tri", "__lines", "__in") if c != text])
    df = df.withColumn("__words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE)))
    df = df.withColumn("__lines", F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn("__tri", F.expr(
        "CASE WHEN size(__words) < 3 THEN CAST(array() AS array<bigint>) ELSE "
        "transform(sequence(0, size(__words) - 3), i -> xxhash64(__words[i], __words[i + 1], __words[i + 2])) END"))
    # Positions of windows that occur twice or more: neighbours of equal hash in the order of (hash, position).
    df = df.withColumn("__in", F.expr(
        "CASE WHEN size(array_distinct(__tri)) = size(__tri) THEN CAST(array() AS array<int>) ELSE "
        "sort_array(array_distinct(flatten(element_at(transform(array(sort_array(transform(__tri, (h, i) -> struct(h, i)))), o -> "
        "filter(zip_with(o, slice(o, 2, size(o)), (a, b) -> if(a.h = b.h, array(a.i, b.i), NULL)), x -> x IS NOT NULL)), 1)))) END"))
    n_symbols = F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))
    df = df.select(
        *[c for c in df.columns if not c.startswith("__")],
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        n_symbols.cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.expr("CASE WHEN size(__in) = 0 THEN 0L ELSE 3L + CAST(aggregate(zip_with(__in, slice(__in, 2, size(__in)), "
               "(a, b) -> if(b IS NULL, 0, least(3, b - a))), 0, (s, x) -> s + x) AS bigint) END").alias("n_repeat_words"))
    return df.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def measure(name: str) -> Column:
    num, den, scale, *_ = RULES[name]
    return F.expr(f"CASE WHEN {den} = 0 THEN 0L ELSE {scale}L * {num} div {den} END")


def rounded(v: Column) -> Column:
    """``v`` rounded down to ``BITS`` significant bits: the sketch's bucket."""
    shift = F.greatest(F.lit(0), F.length(F.bin(v)) - BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)


def sketches(stats: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(grp_lang, grp_source, measure, value, n): the sketch of every group that passes the base rules."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), rounded(measure(m)).alias("value")) for m in RULES])
    return (stats.filter(~F.col("base_failed"))
            .select(F.col(lang).cast("string").alias("grp_lang"), F.col(source).cast("string").alias("grp_source"),
                    F.inline(pairs))
            .groupBy("grp_lang", "grp_source", "measure", "value").agg(F.count("*").alias("n")))


def fences(sketch: DataFrame, prior: int = PRIOR) -> DataFrame:
    """(grp_lang, grp_source, <measure>_lo, <measure>_hi) of every group; a lower fence is null where the rule has none."""
    levels = (sketch.withColumn("level", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
              .select("level", F.when(F.col("level") >= 1, F.col("grp_lang")).alias("grp_lang"),
                      F.when(F.col("level") == 2, F.col("grp_source")).alias("grp_source"), "measure", "value", "n")
              .groupBy("level", "grp_lang", "grp_source", "measure", "value").agg(F.sum("n").alias("n")))
    group = ["level", "grp_lang", "grp_source", "measure"]
    cum = levels.withColumns({"upto": F.sum("n").over(Window.partitionBy(*group).orderBy("value")),
                              "total": F.sum("n").over(Window.partitionBy(*group))})
    q = lambda p: F.min(F.when(F.col("upto") * 4 >= F.col("total") * p, F.col("value")))
    # A sketch has at most some 2**BITS values a power of two.
    quart = (cum.groupBy(*group).agg(q(1).alias("q1"), q(2).alias("q2"), q(3).alias("q3"), F.max("total").alias("total"),
                                     F.collect_list(F.struct("value", "n")).alias("cells"))
             .withColumn("dev", F.expr("aggregate(cells, 0L, (s, c) -> s + c.n * abs(c.value - q2))")))
    out = [F.max("total").alias("total")]
    for m, (_, _, _, spread, reach, margin, two) in RULES.items():
        width = (reach * (F.col("q3") - F.col("q1")) if spread == "quartiles"
                 else F.floor(reach * F.col("dev").cast("double") / F.col("total"))) + margin
        here = F.col("measure") == m
        out += [F.max(F.when(here, F.col("q2") + width)).cast("long").alias(f"{m}_hi"),
                F.max(F.when(here, F.col("q2") - width if two else F.lit(None))).cast("long").alias(f"{m}_lo")]
    own = written(quart.groupBy("level", "grp_lang", "grp_source").agg(*out), "fences")
    cols = [c for c in own.columns if c.endswith(("_lo", "_hi"))]
    top = own.filter("level = 0").first()  # one row; none if no document passes the base rules
    mean = lambda c: F.floor((F.col("total") * F.col(c).cast("double") + prior * F.col(f"up_{c}").cast("double"))
                             / (F.col("total") + prior)).cast("long")
    lang = (own.filter("level = 1").withColumns({f"up_{c}": F.lit(top[c] if top else None).cast("long") for c in cols})
            .select(F.col("grp_lang").alias("up_lang"), *[mean(c).alias(f"up_{c}") for c in cols]))
    return (own.filter("level = 2").join(lang, F.col("grp_lang").eqNullSafe(F.col("up_lang")))
            .select("grp_lang", "grp_source", *[mean(c).alias(c) for c in cols]))


def judge(stats: DataFrame, fence: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Join the fences of each row's group and add ``kept``.  A group without fences has only rows that fail the base rules."""
    df = stats.drop("kept")
    cols = [f"{m}_{s}" for m in RULES for s in ("lo", "hi")]
    limits = fence.select(F.col("grp_lang").alias("__lang"), F.col("grp_source").alias("__source"), *[F.col(c).alias(f"__{c}") for c in cols])
    own = df.columns
    df = df.join(F.broadcast(limits) if limits.count() <= BROADCAST_ROWS else limits,
                 [F.col(lang).cast("string").eqNullSafe(F.col("__lang")), F.col(source).cast("string").eqNullSafe(F.col("__source"))], "left")
    ok = ~F.col("base_failed")
    for m, rule in RULES.items():
        ok = ok & F.coalesce(measure(m) <= F.col(f"__{m}_hi"), F.lit(True))
        if rule[-1]:
            ok = ok & F.coalesce(measure(m) >= F.col(f"__{m}_lo"), F.lit(True))
    return df.select(*own, ok.alias("kept"))


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                  prior: int = PRIOR, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus ``STATS``, ``base_failed`` and ``kept`` for every row.

    The counts are written once in the shared folder, so texts are measured once.
    """
    keep = list(docs.columns if keep is None else keep)
    need = list(dict.fromkeys([*keep, lang, source]))
    measured = with_stats(docs.select(*dict.fromkeys([*need, text])), text)
    stats = written(measured.select(*[c for c in need if c in measured.columns and c not in (*STATS, "base_failed")],
                                    *STATS, "base_failed"), "quality")
    fence = written(fences(sketches(stats, lang, source), prior), "fences")
    out = judge(stats, fence, lang, source)
    return out.select(*[c for c in keep if c not in (*STATS, "base_failed", "kept")], *STATS, "base_failed", "kept")
