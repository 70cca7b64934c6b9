"""Quality scores by nearest-neighbour voting on latent-semantic vectors (operator 11).

Method.  A text's terms are its byte trigrams (space-like bytes and digits each count as
one byte value), its word shapes and pairs of shapes, and how each word relates to the
two before it; terms are hashed into ``TERMS`` columns.  A document vector holds
(1 + log count) * idf, scaled to length 1.  Document frequencies are counted over all
documents.  Labelled texts, at most about ``per_label`` of each label drawn by a hash of
the key, give a term matrix whose truncated singular value decomposition (``DIM``
directions, randomised with power steps) spans the latent space.  Their projected unit
vectors, ``DIM`` floats each and so bounded by ``per_label``, travel to the tasks.  There
every text of every row is projected, the cosines with all labelled vectors are computed
exactly, block by block, and the ``NEIGHBOURS`` nearest vote with weight
max(cosine, 0) ** ``POWER``; a label's votes are divided by its share of the labelled
rows, so that the score does not depend on the classes' sizes.

Defined results: a null, empty or blank text has no terms and gets the score of no
evidence, the labelled rows' share of label 1; so does a text without a positive cosine,
and every text where only one label or no label exists (then 0.5 for none).  Ties at the
last neighbour are broken by the labelled rows' order (hash of the key, then terms).
Equal texts get equal scores (to the last digits of a double).  Very long texts count whole, as one piece.  Null labels
and null keys teach nothing; a key with several labels teaches each of them.  Columns ``score`` and ``predicted``
replace input columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import NOT_SPACE, hashes, mix, pieces, spans
from .ship import ship

TERMS = 2048
DIM = 64
#: Labelled rows of each label, about.
PER_LABEL = 1500
NEIGHBOURS, POWER = 25, 4
BLOCK = 1024

_BYTE = np.arange(256, dtype=np.uint8)
_BYTE[[0x20, 9, 10, 11, 12, 13]] = 0x20
_BYTE[0x30:0x3A] = 0x30
#: Shape of a byte: 0 small letter, 1 capital, 2 digit, 3 mark, 4 not ASCII.
_SHAPE = np.full(256, 3, np.uint8)
_SHAPE[0x61:0x7B], _SHAPE[0x41:0x5B], _SHAPE[0x30:0x3A], _SHAPE[0x80:] = 0, 1, 2, 4


def _column(kind: int, code: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(code.astype(np.uint64) + np.uint64(kind) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(TERMS)).astype(np.int64)


def counts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Term counts, one row of ``TERMS`` a text."""
    n = len(offs) - 1
    out = np.zeros(n * TERMS, np.float32)
    if not len(data):
        return out.reshape(n, TERMS)

    def add(row, kind, code):
        nonlocal out
        out += np.bincount(row * TERMS + _column(kind, code), minlength=n * TERMS).astype(np.float32)

    b = _BYTE[data].astype(np.int64)
    row = np.repeat(np.arange(n), np.diff(offs))
    if len(b) >= 3:
        inside = (row[2:] == row[:-2]) & ((b[2:] != 0x20) | (b[:-2] != 0x20))
        add(row[2:][inside], 1, (b[:-2] * 65536 + b[1:-1] * 256 + b[2:])[inside])
    starts, ends, of = spans(data, offs, NOT_SPACE)
    if not len(starts):  # blanks only: no terms
        return np.zeros((n, TERMS), np.float32)
    shape = _SHAPE[data]
    some = np.zeros(len(starts), np.int64)
    for k in range(5):
        total = np.concatenate(([0], np.cumsum(shape == k)))
        have = total[ends] - total[starts]
        some += 3 ** k * np.where(have == 0, 0, np.where(have == ends - starts, 2, 1))
    kind = some * 32 + np.minimum(ends - starts, 15) // 3 + 8 * (shape[starts] == 1) + 16 * (shape[ends - 1] == 3)
    add(of, 2, kind)
    if len(starts) > 1:
        pair = of[1:] == of[:-1]
        add(of[1:][pair], 3, (kind[:-1] * 65536 + kind[1:])[pair])
        h = hashes(data, starts, ends)
        again = (h[1:] == h[:-1]) + 0
        again[1:] += 2 * ((h[2:] == h[:-2]) & (of[2:] == of[:-2]))
        add(of[1:][pair], 4, (again * 1024 + (ends - starts)[1:].clip(0, 12) // 4)[pair])
    return out.reshape(n, TERMS)


def batches_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, last row + 1, counts) for pieces of a string column, at most ``BLOCK`` rows each."""
    for lo in range(0, len(column), BLOCK):
        part = column.slice(lo, BLOCK)
        for a, b, data, offs in pieces(part):
            yield lo + a, lo + b, counts(data, offs)


def weigh(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(c, dtype=np.float64) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def directions(x: np.ndarray, dim: int, seed: int = 5) -> np.ndarray:
    """The leading right singular vectors of ``x`` as columns, by randomised subspace iteration."""
    rng = np.random.default_rng(seed)
    y = np.linalg.qr(x.T @ (x @ rng.normal(size=(x.shape[1], min(dim + 16, x.shape[1])))))[0]
    for _ in range(4):
        y = np.linalg.qr(x.T @ (x @ y))[0]
    _, _, v = np.linalg.svd(x @ y, full_matrices=False)
    return (y @ v.T)[:, :dim]


class Voters:
    """Labelled unit vectors of the latent space, and their vote."""

    def __init__(self, labelled: np.ndarray, labels: np.ndarray, idf: np.ndarray, dim: int = DIM):
        self.idf = idf
        self.share = float(labels.mean()) if len(labels) else 0.5
        self.one_kind = len(np.unique(labels)) < 2
        if not self.one_kind:
            x = weigh(labelled, self.idf)
            self.basis = directions(x, dim)
            v = x @ self.basis
            self.points = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            self.labels = labels.astype(bool)

    def score(self, c: np.ndarray) -> np.ndarray:
        if self.one_kind:
            return np.full(len(c), self.share)
        v = weigh(c, self.idf) @ self.basis
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        # Rounded, so that the order of additions, which depends on the block's shape, changes no neighbour.
        cosine = np.round(v @ self.points.T, 9)
        k = min(NEIGHBOURS, cosine.shape[1])
        # Ties at the last place go to the earlier labelled row: all above the k-th value, then the first of its equals.
        kth = -np.partition(-cosine, k - 1, axis=1)[:, k - 1: k]
        above = cosine > kth
        equal = cosine == kth
        near = above | (equal & (np.cumsum(equal, 1) <= k - above.sum(1, keepdims=True)))
        vote = np.where(near, np.maximum(cosine, 0) ** POWER, 0)
        good = (vote * self.labels).sum(1) / self.share
        bad = (vote * ~self.labels).sum(1) / (1 - self.share)
        none = (good + bad <= 0) | (c.sum(1) == 0)
        return np.where(none, self.share, good / np.maximum(good + bad, 1e-300))


def document_frequencies(docs: DataFrame, text: str) -> tuple[int, np.ndarray]:
    """(number of texts, number of texts that hold each term), over all rows."""
    def run(batches):
        total, rows = np.zeros(TERMS + 1, np.int64), 0
        for batch in batches:
            for _, _, c in batches_of(batch.column(0)):
                total[:TERMS] += (c > 0).sum(0)
                rows += len(c)
        total[TERMS] = rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1, dtype=np.int32)), pa.array(total)], names=["term", "n"])

    parts = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "term int, n bigint")
    sums = np.zeros(TERMS + 1, np.int64)
    for r in parts.groupBy("term").agg(F.sum("n").alias("n")).collect():  # TERMS + 1 rows
        sums[r["term"]] = r["n"]
    return int(sums[TERMS]), sums[:TERMS]


def examples(docs: DataFrame, labels: DataFrame, text: str, label: str, key: str, per_label: int) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of at most about ``per_label`` rows of each label, the same at every run.

    Keys are drawn from the labels alone, so the texts of all other rows stay where they are.
    """
    known = (labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), (F.col(label) == 1).alias("good"))
             .distinct().withColumn("h", F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit(3)), F.lit(1_000_000))))
    sizes = {r[0]: r[1] for r in known.groupBy("good").count().collect()}
    bound = 2 * per_label * max(len(sizes), 1)
    share = F.lit(0)
    for good, n in sizes.items():
        share = F.when(F.col("good") == good, F.lit(min(1_000_000, -(-per_label * 1_050_000 // n)))).otherwise(share)
    drawn = known.filter(F.col("h") < share).orderBy("h", "key", "good").limit(bound)  # a row count that ``per_label`` bounds
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("t")).join(F.broadcast(drawn), "key").select("h", "good", "t")

    def run(batches):
        for batch in batches:
            for lo, hi, c in batches_of(batch.column(2)):
                at = [np.flatnonzero(r) for r in c]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array([i.astype(np.uint16).tobytes() + r[i].tobytes() for i, r in zip(at, c, strict=True)], pa.binary())],
                    names=["h", "good", "c"])

    # A key may stand on any number of rows: the bound holds for rows too, 6 bytes a term that occurs.
    got = rows.mapInArrow(run, "h bigint, good boolean, c binary").orderBy("h", "c", "good").limit(bound).collect()
    c = np.zeros((len(got), TERMS), np.float32)
    for i, r in enumerate(got):
        m = len(r["c"]) // 6
        c[i, np.frombuffer(r["c"], np.uint16, m)] = np.frombuffer(r["c"], np.float32, m, 2 * m)
    return c, np.array([r["good"] for r in got], np.float64)


def vote(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id",
         per_label: int = PER_LABEL, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus score and predicted for every row of ``docs``.

    ``labels`` holds the keys to learn from and their label, of which 1 is the good one; the key only chooses examples.
    """
    ship()
    n, df = document_frequencies(docs, text)
    idf = np.log((1 + n) / (1 + df)) + 0.1
    model = Voters(*examples(docs, labels, text, label, key, per_label), idf)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    q = lambda c: F.col("`" + c.replace("`", "``") + "`")
    kept = docs.select(*[q(c) for c in keep], q(text).cast("string").alias("__text"))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for batch in batches:
            score = np.zeros(batch.num_rows)
            last = batch.num_columns - 1
            for lo, hi, c in batches_of(batch.column(last)):
                score[lo:hi] = model.score(c)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(last)] + [pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                             names=[*keep, "score", "predicted"])

    return kept.mapInArrow(run, schema)

