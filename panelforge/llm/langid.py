"""Language identification by a byte convolutional network (operator 1).

Method: the network sees fixed windows of ``WINDOW`` bytes.  Filters of several
widths run over the one-hot bytes (a filter of width w is w tables of 256 weights),
each is max-pooled over the window and rectified, and a softmax layer gives the
languages.  It is trained here in numpy (Adam, cross-entropy) on a bounded sample of
labelled texts: at most ``per_lang`` texts a language, one excerpt of at most
``EXCERPT`` characters each, drawn by a hash of the key.  Prediction covers whole
texts: all windows, side by side, weighted by their letters.

Bytes are folded first: ASCII and Latin-1 capitals to small letters, every other
ASCII byte to a blank.

Defined results: ``und`` with score 0 for a null text, a text without a letter, and
where no labelled text exists.  With one learned language all texts get it.  Equal
texts get equal results.  Columns ``lang_pred`` and ``score`` replace input columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import pieces
from .ship import ship

WINDOW = 128
EXCERPT = 1500
PER_LANG = 600
WIDTHS, FILTERS = (2, 3, 4), 24

_MAP = np.zeros(256, np.uint8)
_MAP[0x61:0x7B] = np.arange(0x61, 0x7B)
_MAP[0x41:0x5B] = np.arange(0x61, 0x7B)
_MAP[0x80:] = np.arange(0x80, 0x100)


def fold(data: np.ndarray) -> np.ndarray:
    out = _MAP[data]
    if len(out) > 1:
        upper = np.flatnonzero((out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E)) + 1
        out[upper] += 0x20
    return out


def cut(data: np.ndarray, offs: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows, row of each): every byte of every text once; each window is followed by ``pad`` zeros."""
    size = np.diff(offs)
    k = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), k)
    first = np.cumsum(k) - k
    x = np.zeros((len(row), WINDOW + pad), np.uint8)
    src = np.arange(len(data)) - np.repeat(offs[:-1], size)
    x[np.repeat(first, size) + src // WINDOW, src % WINDOW] = fold(data)
    return x, row


class Network:
    """Filters as tables[width][position] of shape (256, FILTERS)."""

    def __init__(self, n_classes: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {f"t{w}_{k}": rng.normal(0, 0.3, (256, FILTERS)).astype(np.float32) for w in WIDTHS for k in range(w)}
        for w in WIDTHS:
            for k in range(w):
                self.p[f"t{w}_{k}"][0] = 0
        self.p["dense"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), n_classes)).astype(np.float32)
        self.p["bias"] = np.zeros(n_classes, np.float32)

    def pooled(self, x: np.ndarray, where: bool = False):
        best, at = [], []
        for w in WIDTHS:
            a = self.p[f"t{w}_0"][x[:, :WINDOW]]
            for k in range(1, w):
                a += self.p[f"t{w}_{k}"][x[:, k: WINDOW + k]]
            if where:
                at.append(a.argmax(1))
            best.append(a.max(1))
        return np.concatenate(best, 1), at

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(x), 512):
            z = np.maximum(self.pooled(x[i: i + 512])[0], 0) @ self.p["dense"] + self.p["bias"]
            z -= z.max(1, keepdims=True)
            out.append(z - np.log(np.exp(z).sum(1, keepdims=True)))
        return np.concatenate(out) if out else np.zeros((0, len(self.p["bias"])), np.float32)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.004, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                pick = order[i: i + batch]
                xb, yb = x[pick], y[pick]
                pre, at = self.pooled(xb, where=True)
                hid = np.maximum(pre, 0)
                z = hid @ self.p["dense"] + self.p["bias"]
                z = np.exp(z - z.max(1, keepdims=True))
                z /= z.sum(1, keepdims=True)
                z[np.arange(len(yb)), yb] -= 1
                z /= len(yb)
                g = {"dense": hid.T @ z, "bias": z.sum(0)}
                back = (z @ self.p["dense"].T) * (pre > 0)
                rows = np.arange(len(yb))[:, None]
                for j, w in enumerate(WIDTHS):
                    d = back[:, j * FILTERS: (j + 1) * FILTERS]
                    for k in range(w):
                        code = xb[rows, at[j] + k].astype(np.int64) * FILTERS + np.arange(FILTERS)
                        g[f"t{w}_{k}"] = np.bincount(code.ravel(), d.ravel(), 256 * FILTERS).reshape(256, FILTERS)
                step += 1
                lr = rate * (1 - 0.8 * epoch / epochs)
                for name, grad in g.items():
                    m[name] = 0.9 * m[name] + 0.1 * grad
                    v2[name] = 0.999 * v2[name] + 0.001 * grad * grad
                    self.p[name] = (self.p[name] - lr * (m[name] / (1 - 0.9 ** step))
                                    / (np.sqrt(v2[name] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)


def sample(docs: DataFrame, fit: Column, text: str, lang: str, key: str, per_lang: int) -> list[tuple[str, str]]:
    """(language, excerpt) of at most about ``per_lang`` labelled texts a language, the same at every run."""
    ok = docs.filter(fit & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    sizes = {r[0]: r[1] for r in docs.filter(fit & F.col(lang).isNotNull()).groupBy(lang).count().collect()}
    if not sizes:
        return []
    h = F.xxhash64(F.col(key).cast("string"), F.lit(1))
    share = F.lit(0)
    for name, n in sizes.items():
        share = F.when(F.col(lang) == name, F.lit(min(1_000_000, -(-per_lang * 1_100_000 // n)))).otherwise(share)
    start = 1 + F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(2)), F.greatest(F.length(text) - EXCERPT + 1, F.lit(1)))
    drawn = (ok.filter(F.pmod(h, F.lit(1_000_000)) < share)
             .select(F.col(lang).alias("lang"), F.substring(F.col(text), start.cast("int"), F.lit(EXCERPT)).alias("excerpt"), h.alias("h"))
             .orderBy("h", "excerpt").limit(2 * per_lang * len(sizes)).collect())
    return [(r["lang"], r["excerpt"]) for r in drawn]


def train(examples: list[tuple[str, str]]) -> tuple[Network, list[str]] | None:
    if not examples:
        return None
    names = sorted({lang for lang, _ in examples})
    _, _, data, offs = next(pieces(pa.array([t for _, t in examples], pa.large_string()), 1 << 40))
    x, row = cut(data, offs, max(WIDTHS) - 1)
    y = np.array([names.index(lang) for lang, _ in examples])[row]
    useful = (x > 0).sum(1) >= 24
    net = Network(len(names))
    if len(names) > 1 and useful.any():
        net.fit(x[useful], y[useful])
    return net, names


def identify(docs: DataFrame, fit: Column | None = None, text: str = "text", lang: str = "lang", key: str = "doc_id",
             per_lang: int = PER_LANG, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus lang_pred and score for every row.

    ``fit`` marks the rows to learn from (default: all); language and key only choose and label examples.
    """
    ship()
    model = train(sample(docs, F.lit(True) if fit is None else fit, text, lang, key, per_lang))
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    kept = docs.select(*keep, F.col(text).alias("__text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__letter"))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            names = np.full(n, "und", object)
            score = np.zeros(n)
            letter = batch.column("__letter").to_numpy(zero_copy_only=False)
            for lo, hi, data, offs in pieces(batch.column("__text")) if model else ():
                net, langs = model
                x, row = cut(data, offs, max(WIDTHS) - 1)
                logp = net.log_probs(x).astype(np.float64)
                weight = (x > 0).sum(1) + 1e-3
                total = np.stack([np.bincount(row, logp[:, j] * weight, hi - lo) for j in range(len(langs))], 1)
                best = total.argmax(1)
                p = np.bincount(row, np.exp(logp[np.arange(len(row)), best[row]]) * weight, hi - lo)
                has = letter[lo:hi] & (np.diff(offs) > 0)
                names[lo:hi] = np.where(has, np.array(langs, object)[best], "und")
                score[lo:hi] = np.where(has, np.clip(p / np.maximum(np.bincount(row, weight, hi - lo), 1e-9), 0, 1), 0.0)
            cols = [batch.column(c) for c in keep] + [pa.array(names, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "lang_pred", "score"])

    return kept.mapInArrow(run, schema)
