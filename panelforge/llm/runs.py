"""Periodic runs of words by multi-scale minimizers (operator 12).

A run is a stretch of consecutive words whose smallest period is q (words q apart are
identical), at least ``max(MIN_LENGTH, MIN_POWER * q)`` words long, that no neighbouring
word extends with period q.

Method.  Words are 64-bit hashes.  Periods up to ``DIRECT`` are found by comparing the
word array with itself at that lag.  Longer periods are searched by scale: the scale of
L covers periods in (L, 2L].  Its seeds are the windows of 2L words whose hash is the
least of L neighbours (the leftmost one in a tie).  A run of 4q words holds two
neighbourhoods that are q apart and so equal; their minima are equal seeds at distance q,
and no equal seed lies between them, as a window of at least q words recurs inside a run
only after whole periods.  So each seed is paired with the next equal one of its text,
and a pair at a distance d of (L, 2L] is extended to both sides by comparing words d
apart, in growing blocks.  A stretch whose period is a multiple of its smallest one is
left out: its smallest period is found by its own scale.  Nothing is capped: all periods
up to a quarter of the text are covered, and work is about linear in the text's words.

Texts are taken many at a time (``bytewords.PIECE`` bytes of them, or one longer text),
side by side with a word of their own between them, so nothing crosses a text's end.

Defined results: a null or empty text, and a text of blanks, has no words and no runs
and collapses to the empty text.  Equal rows get equal results, row by row.  Very long
texts are one piece each.  Columns ``n_runs``, ``runs`` and ``collapsed`` replace input
columns of those names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import NOT_SPACE, hashes, mix, pieces, spans
from .ship import ship

MIN_LENGTH, MIN_POWER = 6, 4
#: Periods found by direct comparison; longer ones by minimizers.
DIRECT = 16


def maximal(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True that are at least ``least`` long."""
    edge = np.diff(np.concatenate(([0], equal.view(np.int8), [0])))
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = hi - lo >= least
    return lo[long], hi[long]


def prime_factors(n: int) -> list[int]:
    out, f = [], 2
    while f * f <= n:
        if n % f == 0:
            out.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return out + [n] if n > 1 else out


def primitive(words: np.ndarray, start: int, stop: int, period: int) -> bool:
    """Whether no smaller period divides ``period`` (a run of two periods and more has no other smaller one)."""
    first = words[start: start + period]
    return not any(np.array_equal(first[period // f:], first[: period - period // f]) for f in prime_factors(period))


def extend(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The stretch of i around ``at`` with words[i] == words[i + lag]; ``at`` itself is known to be equal."""
    n = len(words) - lag
    step, hi = 64, at
    while hi < n:
        stop = min(n, hi + step)
        wrong = words[hi: stop] != words[hi + lag: stop + lag]
        if wrong.any():
            hi += int(wrong.argmax())
            break
        hi, step = stop, step * 2
    step, lo = 64, at
    while lo > 0:
        start = max(0, lo - step)
        wrong = words[start: lo] != words[start + lag: lo + lag]
        if wrong.any():
            lo -= int(wrong[::-1].argmax())
            break
        lo, step = start, step * 2
    return lo, hi


def window_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least of each ``width`` neighbours, as a sorted set of places."""
    order = np.argsort(x, kind="stable")
    rank = np.empty(len(x), np.int64)
    rank[order] = np.arange(len(x))  # equal values: the leftmost is least
    have, m = 1, rank
    while have * 2 <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    if have < width:
        m = np.minimum(m[: len(m) - (width - have)], m[width - have:])
    picked = np.zeros(len(x), bool)
    picked[order[m]] = True
    return np.flatnonzero(picked)


def seeds(words: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance to the next equal seed) of the seeds whose next equal one is at a distance of (scale, 2 * scale]."""
    span = 2 * scale
    none = np.zeros(0, np.int64)
    if len(words) < span + scale:
        return none, none
    # Hash of the words i .. i + span - 1, by doubling: span is a power of two.
    h, have = mix(words), 1
    with np.errstate(over="ignore"):
        while have < span:
            h = mix(h[:-have] * np.uint64(0x2545F4914F6CDD1D) + h[have:])
            have *= 2
    place = window_minimum(h, scale)
    key = h[place]
    order = np.lexsort((place, key))
    place, key = place[order], key[order]
    gap = place[1:] - place[:-1]
    near = (key[1:] == key[:-1]) & (gap > scale) & (gap <= span)
    return place[:-1][near], gap[near]


def runs_of(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(start, stop, period) of every run, by start and period; ``sizes`` are the lengths of the texts in ``words``.

    A word of its own must follow each text, counted in its size.
    """
    found: list[np.ndarray] = []
    n = len(words)
    same = {}
    for q in range(1, min(DIRECT, n - 1) + 1):
        same[q] = words[q:] == words[:-q]
        lo, hi = maximal(same[q], max(MIN_LENGTH, MIN_POWER * q) - q)
        if len(lo):
            keep = np.ones(len(lo), bool)
            for f in prime_factors(q):
                p = q // f  # the smaller period holds as far as the run's first period goes
                wrong = np.concatenate(([0], np.cumsum(~same[p])))
                keep &= wrong[lo + q - p] > wrong[lo]
            found.append(np.stack([lo[keep], hi[keep] + q, np.full(int(keep.sum()), q)], 1))
    scale = DIRECT
    first = np.cumsum(sizes) - sizes
    while len(sizes) and int(sizes.max()) > MIN_POWER * scale:
        big = sizes > MIN_POWER * scale  # a text and the word behind it
        if not big.all():  # shorter texts hold no period of this scale or a longer one
            take = np.repeat(first[big] - (np.cumsum(sizes[big]) - sizes[big]), sizes[big]) + np.arange(int(sizes[big].sum()))
            part, origin, begin = words[take], first[big], np.cumsum(sizes[big]) - sizes[big]
        else:
            part, origin, begin = words, first, first
        at, lag = seeds(part, scale)
        order = np.lexsort((at, lag))
        done_lag, done = 0, -1
        got = []
        for i, d in zip(at[order].tolist(), lag[order].tolist(), strict=True):
            if d == done_lag and i < done:
                continue
            if part[i] != part[i + d]:
                continue
            lo, hi = extend(part, i, d)
            done_lag, done = d, hi
            if hi - lo >= (MIN_POWER - 1) * d and primitive(part, lo, hi + d, d):
                shift = origin[np.searchsorted(begin, lo, side="right") - 1] - begin[np.searchsorted(begin, lo, side="right") - 1]
                got.append((lo + shift, hi + d + shift, d))
        if got:
            found.append(np.array(got, np.int64))
        scale *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    out = np.unique(np.concatenate(found), axis=0)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def find(data: np.ndarray, offs: np.ndarray):
    """For texts as bytes: (runs with starts in their text, text of each run, collapsed bytes, their offsets)."""
    n = len(offs) - 1
    starts, ends, row = spans(data, offs, NOT_SPACE)
    count = np.bincount(row, minlength=n).astype(np.int64)
    h = hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    # A word of its own behind each text: its hash has the top bit, which words give up.
    words = np.insert(h >> np.uint64(1), np.cumsum(count), (np.uint64(1) << np.uint64(63)) + np.arange(n, dtype=np.uint64))
    runs = runs_of(words, count + 1)
    begin = np.cumsum(count + 1) - (count + 1)
    of = np.searchsorted(begin, runs[:, 0], side="right") - 1
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 1], -1)
    kept = np.cumsum(gone[:-1]) == 0
    mark = np.ones(len(words), bool)
    mark[begin + count] = False
    kept = kept[mark]
    size = (ends - starts)[kept] + 1  # the word and one blank
    src = np.repeat(starts[kept] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    blob = np.append(data, np.uint8(0x20))[src]
    blob[np.cumsum(size) - 1] = 0x20
    words_left = np.bincount(row[kept], minlength=n)
    bytes_left = np.concatenate(([0], np.cumsum(np.bincount(row[kept], size, n)))).astype(np.int64)
    # No blank after a text's last word.
    last = np.flatnonzero(words_left > 0)
    blob = np.delete(blob, bytes_left[last + 1] - 1)
    offsets = bytes_left - np.concatenate(([0], np.cumsum(words_left > 0)))
    out = runs.copy()
    out[:, 0] -= begin[of]
    out[:, 1] -= begin[of]
    return out, of, blob, offsets


RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


def periodic_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus runs (by start, then period), n_runs and collapsed for every row.

    ``collapsed`` holds the words that are not in a run behind its first period, joined by one blank.
    """
    ship()
    new = ("n_runs", "runs", "collapsed")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    name = "`" + text.replace("`", "``") + "`"
    kept = docs.select(*["`" + c.replace("`", "``") + "`" for c in keep], F.col(name).cast("string").alias("__text"))
    run_type = T._parse_datatype_string(RUN)
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_runs", T.LongType()), T.StructField("runs", run_type), T.StructField("collapsed", T.StringType())])
    fields = ("start", "length", "period")

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("__text")
            others = [batch.column(i) for i in range(batch.num_columns) if i != at]
            for lo, hi, data, offs in pieces(batch.column(at)):
                found, of, blob, offsets = find(data, offs)
                number = np.bincount(of, minlength=hi - lo).astype(np.int64)
                structs = pa.StructArray.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1] - found[:, 0]), pa.array(found[:, 2])], fields)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(number))).astype(np.int32)), structs)
                texts = pa.StringArray.from_buffers(hi - lo, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(blob.tobytes()))
                yield pa.RecordBatch.from_arrays([c.slice(lo, hi - lo) for c in others] + [pa.array(number), lists, texts], names=[*keep, *new])

    return kept.mapInArrow(run, schema)


def planted(text: Column, key: Column) -> Column:
    """The contract's text: where crc32 of the key's text ends in 0, the words from one place on repeat with one period.

    With h that crc32 and g = floor(h / 10), word i >= a = g % n becomes word a + (i - a) % p for p = 1 + floor((n - a) / (3 + g % 8)).
    A null key plants nothing.
    """
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def rewritten(words: Column) -> Column:
        # Each value below is an array of one element, so that transform binds it once for all words.
        n = F.size(words).cast("long")
        a = F.try_mod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")

        def with_bounds(b: Column) -> Column:
            index = lambda i: F.when(i < b["a"], i).otherwise(b["a"] + (i - b["a"]) % b["p"])
            return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), b["n"] - 1), lambda i: F.get(words, index(i).cast("int"))), " ")

        return F.when(n > 0, F.element_at(F.transform(F.array(F.struct(n.alias("n"), a.alias("a"), p.alias("p"))), with_bounds), 1)).otherwise(F.lit(""))

    pattern = F.lit(r"[^\x20\x09-\x0D]+")
    changed = F.element_at(F.transform(F.array(F.regexp_extract_all(text, pattern, F.lit(0))), rewritten), 1)
    return F.when((h % 10 == 0) & text.isNotNull(), changed).otherwise(text)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The longest run of each text (ties: the first start, then period) and sha256 of its runs and of what is left."""
    best = F.get(F.array_sort("runs", lambda x, y: F.when(x["length"] > y["length"], -1).when(x["length"] < y["length"], 1)
                              .when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1)
                              .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)), 0)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                                            r["period"].cast("string")), F.lit("\n"))), "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return (found.withColumn("__best", best)
            .select(key, "n_runs", F.col("__best.start").alias("start"), F.col("__best.length").alias("length"), F.col("__best.period").alias("period"),
                    F.expr("__best.length * 1000 div __best.period").alias("exponent_milli"),
                    sha(lines).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256")))
