"""Hidden Markov language model (operator 4).

Method.  Words and one end token a text are counted exactly over the training texts.
The ``SYMBOLS`` most frequent words are observation symbols of their own, the end
token is one, and every other word belongs to one of ``CLASSES`` classes by its last
two bytes; within a class a word has its smoothed relative count.  A model of
``STATES`` latent states over these symbols starts from a bounded sample (only a
starting point) and is then trained by Baum-Welch: each task computes the expected
counts of its texts (cut to segments of ``SEGMENT`` tokens for training), Spark sums
them per symbol, and the driver, which gets one row a symbol, renormalises.  Scoring
runs the scaled forward recursion over every whole text and is exact.

Scale.  The driver holds ``KNOWN`` counts and ``SYMBOLS`` x ``STATES`` emissions, fixed
bounds.  Counts of all other words meet the texts by a shuffled join on the word's
hash; none of them is frequent, so no key of that join is hot.

Words are identified by 64-bit hashes.  Defined results: a null or empty text is the
end token alone.  Rows are scored one by one, so repeats and null ids do not matter.
Without a training token the scores are those of the smoothing alone.  Output has the
columns in ``keep`` and those named in ``score_texts``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import FOLD, NOT_SPACE, hashes, pieces, spans
from .scratch import written
from .ship import ship

STATES, SYMBOLS, CLASSES, KNOWN = 8, 32_768, 256, 200_000
SEGMENT, ITERATIONS, SAMPLE, SAMPLE_ITERATIONS = 128, 3, 400, 12
#: Tokens of the overall symbol frequencies that each state counts beside its own.
SMOOTHING = 1000.0
END = np.uint64(0x5E6D0F7EAD10C0DE)
END_CLASS = CLASSES
N_SYMBOLS = SYMBOLS + CLASSES + 1
#: Unique words that a counting task holds before it passes them on.
HOLD = 3_000_000


def tokens(data: np.ndarray, offs: np.ndarray):
    """Hash, class and row of every word, in order."""
    data = FOLD[data]
    starts, ends, row = spans(data, offs, NOT_SPACE)
    h = hashes(data, starts, ends)
    last = data[ends - 1].astype(np.int64)
    before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.int64)
    return h, ((last * 31 + before) * 2654435761 >> 8) % CLASSES, row


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(hash, cls, n) of every distinct token, the end token included."""
    def run(batches):
        held, ends = [], 0

        def merged():
            h = np.concatenate([x[0] for x in held])
            order = np.argsort(h, kind="stable")
            h, c, n = h[order], np.concatenate([x[1] for x in held])[order], np.concatenate([x[2] for x in held])[order]
            at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            return h[at], c[at], np.add.reduceat(n, at)

        def out(x):
            return pa.RecordBatch.from_arrays([pa.array(signed(x[0])), pa.array(x[1], pa.int32()), pa.array(x[2])], names=["hash", "cls", "n"])

        for batch in batches:
            ends += batch.num_rows
            for _, _, data, offs in pieces(batch.column(0)):
                h, c, _ = tokens(data, offs)
                if len(h):
                    u, at, n = np.unique(h, return_index=True, return_counts=True)
                    held.append((u, c[at], n.astype(np.int64)))
                if sum(len(x[0]) for x in held) > HOLD:
                    held = [merged()]
                    if len(held[0][0]) > HOLD // 2:
                        yield out(held[0])
                        held = []
        if held:
            yield out(merged())
        if ends:
            yield out((np.array([END]), np.array([END_CLASS]), np.array([ends], np.int64)))

    return (docs.select(text).mapInArrow(run, "hash long, cls int, n long")
            .groupBy("hash", "cls").agg(F.sum("n").alias("n")))


def most_frequent(vocab: DataFrame, limit: int) -> list:
    """At most ``limit`` words of the highest counts: all counts from the lowest that still fits."""
    shift = F.greatest(F.lit(0), F.length(F.bin("n")) - 8)
    low = F.call_function("shiftleft", F.call_function("shiftright", F.col("n"), shift), shift)
    sizes = sorted(vocab.groupBy(low.alias("low")).agg(F.count("*").alias("k")).collect(), key=lambda r: -r["low"])
    total, least = 0, None
    for r in sizes:
        total += r["k"]
        if total > limit:
            break
        least = r["low"]
    return [] if least is None else sorted(vocab.filter(F.col("n") >= least).collect(), key=lambda r: (-r["n"], r["hash"]))


class Model:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # (S,), (S, S), (symbols, S)

    def log_likelihood(self, obs: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Natural log likelihood of each sequence; ``obs`` concatenated, ``size`` their lengths (at least 1)."""
        order = np.argsort(-size, kind="stable")
        at, left = (np.cumsum(size) - size)[order], size[order]
        ll = np.zeros(len(size))
        a = self.start * self.emit[obs[at]]
        live = len(size)
        for t in range(int(left[0]) if len(left) else 0):
            if t:
                live = int(np.searchsorted(-left, -t, side="left"))  # those longer than t
                a = (a[:live] @ self.move) * self.emit[obs[at[:live] + t]]
            c = a.sum(1)
            ll[:live] += np.log(c)
            a /= c[:, None]
        out = np.empty(len(size))
        out[order] = ll
        return out

    def expect(self, x: np.ndarray, first: np.ndarray):
        """Expected counts over segments of equal length: start, moves, emissions (symbols, S).

        ``x`` is (segments, steps), -1 after the end of a segment; ``first`` marks those that begin a text.
        """
        n, steps = x.shape
        s = len(self.start)
        fw, scale = np.zeros((steps, n, s)), np.ones((steps, n))
        mass = self.start @ np.linalg.matrix_power(self.move, 32)
        live = x >= 0
        prob = np.where(live.T[:, :, None], self.emit[np.maximum(x, 0).T], 1.0)
        a = np.where(first[:, None], self.start, mass) * prob[0]
        for t in range(steps):
            if t:
                a = np.where(live[:, t, None], (a @ self.move) * prob[t], a)
            c = a.sum(1)
            a = a / c[:, None]
            fw[t], scale[t] = a, c
        back = np.ones((n, s))
        moves = np.zeros((s, s))
        gamma = np.empty_like(fw)
        gamma[-1] = fw[-1]
        for t in range(steps - 1, 0, -1):
            on = live[:, t]
            w = prob[t] * back / scale[t][:, None]
            w[~on] = 0
            moves += fw[t - 1].T @ w
            back = np.where(on[:, None], w @ self.move.T, back)
            gamma[t - 1] = fw[t - 1] * back
        moves *= self.move
        keep = live.T
        sym = x.T[keep]
        emit = np.stack([np.bincount(sym, gamma[:, :, k][keep], N_SYMBOLS) for k in range(s)], 1)
        return gamma[0][first].sum(0), moves, emit

    @staticmethod
    def of_counts(start, moves, emit, prior: np.ndarray) -> Model:
        start = (start + 0.1) / (start + 0.1).sum()
        moves = moves + 0.1
        emit = emit + SMOOTHING * prior[:, None]
        return Model(start, moves / moves.sum(1, keepdims=True), emit / emit.sum(0))


def segments(obs: np.ndarray, size: np.ndarray):
    """Cut sequences to rows of SEGMENT steps, padded with -1."""
    k = -(-size // SEGMENT)
    row = np.cumsum(k) - k
    at = np.arange(len(obs)) - np.repeat(np.cumsum(size) - size, size)
    x = np.full((int(k.sum()), SEGMENT), -1, np.int32)
    x[np.repeat(row, size) + at // SEGMENT, at % SEGMENT] = obs
    first = np.zeros(len(x), bool)
    first[row] = True
    return x, first


def unpack(column) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all rows of a binary column, and their number by row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offs[0]: offs[-1]]
    return np.frombuffer(data.tobytes(), np.uint16).astype(np.int64), np.diff(offs) // 2


def encode(docs: DataFrame, keep: list[str], text: str, known: list, class_mass: np.ndarray, z: float) -> DataFrame:
    """One row a text: its symbols, sums over the words whose counts are known here, and its other words."""
    khash = np.array([r["hash"] for r in known], np.int64).view(np.uint64)
    order = np.argsort(khash)
    khash = khash[order]
    kcount = np.array([r["n"] for r in known], np.float64)[order]
    rank = order  # known[] is sorted by count: its index is the frequency rank
    end_n = next((float(r["n"]) for r in known if r["hash"] == int(np.array([END]).view(np.int64)[0])), 0.0)
    lmass = np.log10(class_mass)

    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in pieces(batch.column("__text")):
                n = hi - lo
                h, cls, row = tokens(data, offs)
                size = np.bincount(row, minlength=n)
                at = np.searchsorted(khash, h) if len(khash) else np.zeros(len(h), np.int64)
                at = np.minimum(at, max(len(khash) - 1, 0))
                hit = (khash[at] == h) if len(khash) else np.zeros(len(h), bool)
                c = np.where(hit, kcount[at] if len(khash) else 0.0, 0.0)
                own = hit & ((rank[at] if len(khash) else at) < SYMBOLS)
                sym = np.where(own, rank[at] if len(khash) else 0, SYMBOLS + cls)
                lc = np.log10(c + 0.1)
                base = np.bincount(row, np.where(hit, lc - math.log10(z), -math.log10(z)), n) + math.log10((end_n + 0.1) / z)
                inner = np.bincount(row, np.where(own, 0.0, np.where(hit, lc, 0.0) - lmass[cls]), n)
                # The symbols of a row, then the end token's.
                first = np.cumsum(size + 1) - (size + 1)
                obs = np.full(int(first[-1] + size[-1] + 1), SYMBOLS + END_CLASS, np.uint16)
                place = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
                obs[place] = sym
                boffs = np.concatenate((first, [len(obs)])).astype(np.int32) * 2
                blob = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(boffs.tobytes()), pa.py_buffer(obs.tobytes())])
                # Words whose counts are not known here, with their number, by row.
                rh, rr = h[~hit], row[~hit]
                o = np.lexsort((rh, rr))
                rh, rr = rh[o], rr[o]
                new = np.flatnonzero(np.concatenate(([True], (rh[1:] != rh[:-1]) | (rr[1:] != rr[:-1])))) if len(rh) else np.zeros(0, np.int64)
                tf = np.diff(np.append(new, len(rh)))
                loffs = np.concatenate(([0], np.cumsum(np.bincount(rr[new], minlength=n)))).astype(np.int32)
                other = pa.ListArray.from_arrays(pa.array(loffs), pa.StructArray.from_arrays(
                    [pa.array(signed(rh[new])), pa.array(tf, pa.int32())], names=["hash", "tf"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(lo, n) for k in [*keep, "__fit"]]
                    + [pa.array(size + 1, pa.int64()), pa.array(np.bincount(row, hit, n).astype(np.int64) + (end_n > 0)),
                       pa.array(base), pa.array(inner), blob, other],
                    names=[*keep, "__fit", "n_tokens", "__known", "__base", "__inner", "__obs", "__other"])

    schema = T.StructType([docs.schema[c] for c in [*keep, "__fit"]] + T._parse_datatype_string(
        "n_tokens long, __known long, __base double, __inner double, __obs binary, __other array<struct<hash:long,tf:int>>").fields)
    return docs.select(*keep, "__fit", F.col(text).alias("__text")).mapInArrow(run, schema)


def baum_welch(coded: DataFrame, model: Model, prior: np.ndarray) -> Model:
    """One iteration over all training rows: expected counts by task, summed by Spark."""
    s = len(model.start)

    def run(batches):
        start, moves, emit = np.zeros(s), np.zeros((s, s)), np.zeros((N_SYMBOLS, s))
        for batch in batches:
            obs, size = unpack(batch.column(0))
            x, first = segments(obs, size)
            for i in range(0, len(x), 1024):
                for total, part in zip((start, moves, emit), model.expect(x[i: i + 1024], first[i: i + 1024]), strict=True):
                    total += part
        at = np.flatnonzero(emit.any(1))
        ids = np.concatenate((at, -1 - np.arange(s + 1)))  # -1: start, -2...: a row of moves each
        rows = np.concatenate((emit[at], start[None], moves))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())] + [pa.array(rows[:, k]) for k in range(s)],
                                         names=["id"] + [f"s{k}" for k in range(s)])

    sums = (coded.filter("__fit").select("__obs").mapInArrow(run, "id long, " + ", ".join(f"s{k} double" for k in range(s)))
            .groupBy("id").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(s)]).collect())  # at most N_SYMBOLS + STATES + 1 rows
    start, moves, emit = np.zeros(s), np.zeros((s, s)), np.zeros((N_SYMBOLS, s))
    for r in sorted(sums, key=lambda r: r["id"]):
        v = np.array(r[1:], float)
        if r["id"] >= 0:
            emit[r["id"]] = v
        elif r["id"] == -1:
            start = v
        else:
            moves[-2 - r["id"]] = v
    return Model.of_counts(start, moves, emit, prior)


def starting_model(coded: DataFrame, prior: np.ndarray) -> Model:
    """From a bounded sample: random emissions around the symbol frequencies, sticky states, a few local iterations."""
    rng = np.random.default_rng(5)
    model = Model(np.full(STATES, 1 / STATES), np.full((STATES, STATES), 0.1 / STATES) + 0.9 * np.eye(STATES), np.ones((N_SYMBOLS, STATES)))
    emit = prior[:, None] * np.exp(rng.normal(0, 0.7, (N_SYMBOLS, STATES)))
    model.emit = emit / emit.sum(0)
    drawn = (coded.filter("__fit").select(F.substring(F.col("__obs"), 1, 2 * 2 * SEGMENT).alias("o"), F.xxhash64("__obs").alias("h"))
             .orderBy("h").limit(SAMPLE).collect())
    seqs = [np.frombuffer(r["o"], np.uint16).astype(np.int64) for r in drawn]
    if seqs:
        x, first = segments(np.concatenate(seqs), np.array([len(q) for q in seqs]))
        for _ in range(SAMPLE_ITERATIONS):
            model = Model.of_counts(*model.expect(x, first), prior)
    return model


def score_texts(docs: DataFrame, fit: Column | None = None, text: str = "text", keep: list[str] | None = None,
                iterations: int = ITERATIONS) -> DataFrame:
    """keep, n_tokens, n_known, train_tokens, base_score, score: one row a text.

    ``fit`` marks the training rows (default: all).  base_score is the smoothed unigram's log10 probability,
    score the model's.
    """
    ship()
    own = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in own]
    df = docs.withColumn("__fit", F.coalesce(F.lit(True) if fit is None else fit, F.lit(False)))
    vocab = written(count_words(df.filter("__fit"), text), "hmm-vocab")
    n_all, v_all = vocab.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    z = n_all + 0.1 * (v_all + 1)
    known = most_frequent(vocab, KNOWN)
    end = int(np.array([END]).view(np.int64)[0])
    if not any(r["hash"] == end for r in known):
        known = known[: KNOWN - 1] + vocab.filter(F.col("hash") == end).collect()
    known = [r for r in known if r["hash"] != end][: KNOWN - 1] + [r for r in known if r["hash"] == end]
    mass = {r["cls"]: (r["c"], r["v"]) for r in vocab.groupBy("cls").agg(F.sum("n").alias("c"), F.count("*").alias("v")).collect()}
    for r in known[:SYMBOLS]:  # frequent words are no members of a class
        if r["hash"] != end:
            c, v = mass[r["cls"]]
            mass[r["cls"]] = (c - r["n"], v - 1)
    class_mass = np.array([mass.get(k, (0, 0))[0] + 0.1 * (mass.get(k, (0, 0))[1] + 1) for k in range(CLASSES + 1)])
    prior = np.zeros(N_SYMBOLS)
    for i, r in enumerate(known[:SYMBOLS]):
        if r["hash"] != end:
            prior[i] = r["n"]
    prior[SYMBOLS:] = class_mass
    prior = (prior + 0.1) / (prior + 0.1).sum()

    coded = written(encode(df, keep, text, known, class_mass, z).withColumn("__row", F.monotonically_increasing_id()), "hmm-coded")
    model = starting_model(coded, prior)
    for _ in range(iterations):
        model = baum_welch(coded, model, prior)

    def run(batches):
        for batch in batches:
            obs, size = unpack(batch.column("__obs"))
            ll = model.log_likelihood(obs, size) / math.log(10) if len(size) else np.zeros(0)
            cols = {c: batch.column(c) for c in batch.schema.names if c != "__obs"}
            yield pa.RecordBatch.from_arrays([*cols.values(), pa.array(ll)], names=[*cols, "__ll"])

    flat = coded.select(*keep, "__row", "n_tokens", "__known", "__base", "__inner", "__obs")
    scored = flat.mapInArrow(run, T.StructType([f for f in flat.schema if f.name != "__obs"] + [T.StructField("__ll", T.DoubleType())]))
    # Counts of the other words: joined by hash, summed by row.
    rare = (coded.select("__row", F.inline("__other")).join(vocab.select("hash", "n"), "hash", "left")
            .groupBy("__row").agg(F.sum(F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("__rare"),
                                  F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("__more")))
    extra = F.coalesce("__rare", F.lit(0.0))
    return (scored.join(rare, "__row", "left")
            .select(*keep, "n_tokens", (F.col("__known") + F.coalesce("__more", F.lit(0))).alias("n_known"),
                    F.lit(int(n_all)).cast("long").alias("train_tokens"), (F.col("__base") + extra).alias("base_score"),
                    (F.col("__ll") + F.col("__inner") + extra).alias("score")))
