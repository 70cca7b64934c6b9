"""URL filter by a ratio of character language models (operator 6), DataFrame functions only.

Method: rules decide some URLs; those are the accepted and rejected examples.  Two
variable-order Markov models (contexts of 2, 1 and 0 characters, Witten-Bell
interpolated) are estimated from trigram counts of all examples.  A URL's score is
the log-likelihood difference per character; the cut between allow and block is the
score bin with the least balanced error on the examples.

Characters outside the fixed alphabet of 49 symbols count as one, so there are at
most 49**3 = 117,649 trigrams: the score table that is broadcast has a fixed bound of
some 5 MB.  Log ratios are integers (millionths), so sums do not depend on order.

Defined results: a null URL or one without ``://`` has empty host and path, no rule,
and is scored as the empty string.  If either class has no example, what no rule
decides is allowed.  Repeated rows are judged alike; a very long URL takes time in proportion
to its length; a score in the cut's bin is allowed.  Output has only the columns
named here and those in ``keep``.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
OTHER = r"[^a-z0-9./?=&#%:_-]"
SYMBOLS = 26 + 10 + 10 + 1 + 2  # letters, digits, marks, any other, the two ends
SCALE, BIN, CLIP = 1_000_000, 10_000, 2000


def with_parts(pages: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """Add ``__rest`` (what follows the first ``://``), host, path, rule and the rule's verdict."""
    u = F.col(url)
    at = F.instr(u, "://")
    ascii_lower = lambda c: F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    df = (pages.withColumn("__rest", F.when(u.isNull() | (at == 0), F.lit("")).otherwise(F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")))
          .withColumn("__raw", F.regexp_extract("__rest", r"^[^/?#]*", 0))
          .withColumn("host", ascii_lower(F.col("__raw")))
          .withColumn("path", F.regexp_extract(F.expr("substring(__rest, length(__raw) + 1)"), r"^[^?#]*", 0))
          .withColumn("__rest", ascii_lower(F.col("__rest"))).drop("__raw"))
    rule: Column = F.lit(None).cast("string")
    verdict: Column = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):  # the longest is tried first
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return df.withColumn("rule", rule).withColumn("__label", verdict)


def grams(parts: DataFrame) -> DataFrame:
    """(__row, __label, __gram): one row a trigram of the padded URL, which is cut into characters once."""
    padded = F.concat(F.lit("^^"), F.regexp_replace("__rest", OTHER, "*"), F.lit("$"))
    return (parts.select("__row", "__label", F.split(padded, "").alias("__c"))
            .select("__row", "__label", F.explode(F.expr(
                "slice(zip_with(zip_with(__c, slice(__c, 2, size(__c)), (a, b) -> concat(a, b)), slice(__c, 3, size(__c)), "
                "(ab, c) -> concat(ab, c)), 1, size(__c) - 2)")).alias("__gram")))


MODEL_SQL = f"""
WITH g AS (SELECT label, gram, n FROM {{counts}}),
tri AS (SELECT label, substring(gram, 1, 2) AS ab, substring(gram, 2, 1) AS b, substring(gram, 3, 1) AS ch, n FROM g WHERE label IS NOT NULL),
c2 AS (SELECT label, ab, b, ch, sum(n) AS n FROM tri GROUP BY 1, 2, 3, 4),
t2 AS (SELECT label, ab, sum(n) AS n, count(*) AS t FROM c2 GROUP BY 1, 2),
c1 AS (SELECT label, b, ch, sum(n) AS n FROM tri GROUP BY 1, 2, 3),
t1 AS (SELECT label, b, sum(n) AS n, count(*) AS t FROM c1 GROUP BY 1, 2),
c0 AS (SELECT label, ch, sum(n) AS n FROM tri GROUP BY 1, 2),
t0 AS (SELECT label, sum(n) AS n FROM c0 GROUP BY 1),
seen AS (SELECT DISTINCT gram, substring(gram, 1, 2) AS ab, substring(gram, 2, 1) AS b, substring(gram, 3, 1) AS ch FROM g),
each AS (SELECT 'allow' AS label, seen.* FROM seen UNION ALL SELECT 'block' AS label, seen.* FROM seen),
p AS (SELECT s.gram, s.ab, s.b, s.ch, t0.label,
        (coalesce(c0.n, 0) + 1.0e0) / (t0.n + {SYMBOLS}) AS p0
      FROM each s JOIN t0 ON t0.label = s.label LEFT JOIN c0 ON c0.label = t0.label AND c0.ch = s.ch),
p1 AS (SELECT p.*, CASE WHEN t1.n IS NULL THEN p0 ELSE (coalesce(c1.n, 0) + t1.t * p0) / (t1.n + t1.t) END AS p1
       FROM p LEFT JOIN t1 ON t1.label = p.label AND t1.b = p.b LEFT JOIN c1 ON c1.label = p.label AND c1.b = p.b AND c1.ch = p.ch),
p2 AS (SELECT p1.gram, p1.label, CASE WHEN t2.n IS NULL THEN p1 ELSE (coalesce(c2.n, 0) + t2.t * p1) / (t2.n + t2.t) END AS p2
       FROM p1 LEFT JOIN t2 ON t2.label = p1.label AND t2.ab = p1.ab LEFT JOIN c2 ON c2.label = p1.label AND c2.ab = p1.ab AND c2.ch = p1.ch)
SELECT gram, CAST(round({SCALE} * (ln(max(CASE WHEN label = 'allow' THEN p2 END)) - ln(max(CASE WHEN label = 'block' THEN p2 END)))) AS BIGINT) AS llr
FROM p2 GROUP BY gram"""


def judge_urls(pages: DataFrame, url: str = "url", rules=RULES, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """keep, host, path, rule, verdict, score (mean millionths of a nat; null if the models have no examples)."""
    spark = pages.sparkSession
    # Written once, so that row numbers hold; the trigrams of a long URL carry its number, not the URL.
    parts = written(with_parts(pages.select(*dict.fromkeys([*keep, url])).withColumn("__row", F.monotonically_increasing_id()), url, rules), "url-parts")
    exploded = grams(parts)
    counts = written(exploded.groupBy(F.col("__label").alias("label"), F.col("__gram").alias("gram"))
                     .agg(F.count("*").alias("n")), "url-grams")
    view = f"url_counts_{uuid.uuid4().hex}"
    counts.createOrReplaceTempView(view)
    model = written(spark.sql(MODEL_SQL.format(counts=view)), "url-model")
    spark.catalog.dropTempView(view)
    trained = counts.filter("label IS NOT NULL").select("label").distinct().count() == 2
    own = [c for c in keep if c not in ("host", "path", "rule", "verdict", "score")]
    if not trained:
        return parts.select(*own, "host", "path", "rule", F.coalesce("__label", F.lit("allow")).alias("verdict"),
                            F.lit(None).cast("long").alias("score"))
    scored = (exploded.join(F.broadcast(model), F.col("__gram") == F.col("gram"))
              .groupBy("__row").agg(F.sum("llr").alias("__sum"), F.count("*").alias("__n"))
              .select("__row", F.expr("CAST(floor(__sum / __n) AS bigint)").alias("score")))
    scored = parts.select("__row", *own, "host", "path", "rule", "__label").join(scored, "__row")
    scored = written(scored.withColumn("__bin", F.expr(f"greatest(-{CLIP}, least({CLIP}, CAST(floor(score / {BIN}) AS int)))")), "url-scores")
    cut = cut_point(scored)
    method = F.when(F.col("__bin") >= cut, "allow").otherwise("block")
    return scored.select(*own, "host", "path", "rule", F.coalesce("__label", method).alias("verdict"), "score")


def cut_point(scored: DataFrame) -> int:
    """The bin from which URLs are allowed: least balanced error on the examples, then nearest to 0, then lowest."""
    bins = (scored.filter("__label IS NOT NULL").groupBy("__bin")
            .agg(F.count(F.when(F.col("__label") == "allow", 1)).alias("a"), F.count(F.when(F.col("__label") == "block", 1)).alias("b"))
            .collect())  # at most 2 * CLIP + 1 rows
    a, b = sum(r["a"] for r in bins) or 1, sum(r["b"] for r in bins) or 1
    best = None
    for cut in [r["__bin"] for r in bins]:
        err = sum(r["a"] for r in bins if r["__bin"] < cut) * b + sum(r["b"] for r in bins if r["__bin"] >= cut) * a
        best = min(best or (err, abs(cut), cut), (err, abs(cut), cut))
    return best[2]
