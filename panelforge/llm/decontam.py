"""Benchmark decontamination by a prefix-filtered set join (operator 9).

Method.  Words are lower-cased runs of ASCII letters, digits and any character
beyond ASCII.  A window of an item is ``WINDOW`` consecutive words (a shorter item is
one window).  Containment must be full, so of a window's words, ordered by how rare
they are in the documents, a prefix of one is enough: the window is filed under its
rarest word, with that word's position.  A document word that is filed joins its
windows; the length bound (the window fits between the document's ends) and the
positional bound (its start follows from the position) leave one place, and all its
words are then compared.

Scale.  The documents are only scanned, never shuffled: once to count the items'
words, once to match.  The items are a stated query set, taken in blocks of at most
``BLOCK_BYTES`` of text; each block's index is sent to the executors, and a further
block is a further scan of the same rows.

Words are compared by 64-bit hash (all words of a window).  Defined results: null
texts have no words; items without a word have no window.  Rows of one item_id are
one item with all their windows; a null item_id is written ``null``.  Repeated
documents are judged alike; an empty benchmark marks nothing.  Columns n_words,
spans and items replace input columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import ALNUM, pieces, word_hashes
from .ship import ship

WINDOW, BLOCK_BYTES = 10, 32 << 20


def item_words(items: list[tuple[str, str]]) -> list[tuple[str, np.ndarray]]:
    out = []
    for lo, hi, data, offs in pieces(pa.array([t or "" for _, t in items], pa.large_string())):
        h, row = word_hashes(data, offs, ALNUM)
        cut = np.searchsorted(row, np.arange(hi - lo + 1))
        out += [(items[lo + i][0], h[cut[i]: cut[i + 1]]) for i in range(hi - lo)]
    return out


class Index:
    """Windows of a block of items, sorted by their rarest word."""

    def __init__(self, words: list[tuple[str, np.ndarray]], counts: dict[int, int], width: int):
        names = sorted({name for name, h in words if len(h)})
        number = {name: i for i, name in enumerate(names)}
        found: dict[tuple, set[int]] = {}
        for name, h in words:
            if len(h):
                n = min(width, len(h))
                for i in range(len(h) - n + 1):
                    found.setdefault(tuple(h[i: i + n].tolist()), set()).add(number[name])
        self.names = np.array(names, object)
        rows = []
        for window, who in found.items():
            at = min(range(len(window)), key=lambda i: (counts.get(window[i], 0), window[i]))
            rows.append((window[at], at, window, sorted(who)))
        rows.sort(key=lambda r: (r[0], r[1], r[2]))
        self.key = np.array([r[0] for r in rows], np.uint64)
        self.at = np.array([r[1] for r in rows], np.int64)
        self.size = np.array([len(r[2]) for r in rows], np.int64)
        self.words = np.zeros((len(rows), width), np.uint64)
        for i, r in enumerate(rows):
            self.words[i, : len(r[2])] = r[2]
        self.who = np.array([w for r in rows for w in r[3]], np.int64)
        self.who_at = np.concatenate(([0], np.cumsum([len(r[3]) for r in rows]))).astype(np.int64)

    def match(self, h: np.ndarray, row: np.ndarray, n_rows: int):
        """(start, window) of every occurrence; starts are positions in ``h``."""
        lo = np.searchsorted(self.key, h, side="left")
        some = np.flatnonzero((lo < len(self.key)) & (self.key[np.minimum(lo, len(self.key) - 1)] == h)) if len(self.key) else np.zeros(0, np.int64)
        many = np.searchsorted(self.key, h[some], side="right") - lo[some]
        pos = np.repeat(some, many)
        win = np.repeat(lo[some], many) + np.arange(len(pos)) - np.repeat(np.cumsum(many) - many, many)
        first = np.searchsorted(row, np.arange(n_rows + 1))
        start = pos - self.at[win]
        inside = (start >= first[row[pos]]) & (start + self.size[win] <= first[row[pos] + 1])
        start, win = start[inside], win[inside]
        for i in range(self.words.shape[1]):
            ok = (i >= self.size[win]) | (h[np.minimum(start + i, len(h) - 1)] == self.words[win, i])
            start, win = start[ok], win[ok]
        return start, win


def count_item_words(docs: DataFrame, text: str, wanted: np.ndarray) -> dict[int, int]:
    """How often each wanted word occurs in all documents (at most a block's words)."""
    wanted = np.unique(wanted)

    def run(batches):
        n = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for _, _, data, offs in pieces(batch.column(0)):
                h, _ = word_hashes(data, offs, ALNUM)
                at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
                n += np.bincount(at[wanted[at] == h], minlength=len(wanted))
        keep = n > 0
        yield pa.RecordBatch.from_arrays([pa.array(wanted[keep].view(np.int64)), pa.array(n[keep])], names=["h", "n"])

    if not len(wanted):
        return {}
    rows = docs.select(text).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).toPandas()
    return dict(zip(rows["h"].to_numpy(np.int64).view(np.uint64).tolist(), rows["n"].tolist(), strict=True))


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus n_words, spans (hit word ranges, merged) and items (their ids, sorted as strings)."""
    ship()
    own = ["n_words", "spans", "items"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in own]
    name = F.coalesce(F.col(item_id).cast("string"), F.lit("null"))
    items = benchmark.select(name.alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // BLOCK_BYTES))
    schema = T.StructType([docs.schema[c] for c in keep] + T._parse_datatype_string(
        "__text string, n_words long, spans array<struct<start:long,stop:long>>, items array<string>").fields)
    df = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"), F.lit(0).cast("long").alias("n_words"),
                     F.expr("CAST(array() AS array<struct<start:bigint,stop:bigint>>)").alias("spans"),
                     F.expr("CAST(array() AS array<string>)").alias("items"))
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for b in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == b)
        words = item_words([(r["id"], r["t"]) for r in part.collect()])
        every = np.concatenate([h for _, h in words]) if words else np.zeros(0, np.uint64)
        index = Index(words, count_item_words(docs, text, every), window)

        def run(batches, index=index):
            for batch in batches:
                n_words = np.zeros(batch.num_rows, np.int64)
                spans = batch.column("spans").to_pylist()
                items = batch.column("items").to_pylist()
                for lo, hi, data, offs in pieces(batch.column("__text")):
                    h, row = word_hashes(data, offs, ALNUM)
                    n_words[lo:hi] = np.bincount(row, minlength=hi - lo)
                    start, win = index.match(h, row, hi - lo)
                    first = np.searchsorted(row, np.arange(hi - lo + 1))
                    doc = row[start]
                    for d in np.unique(doc).tolist():
                        mine = doc == d
                        w = win[mine]
                        a = start[mine] - first[d]
                        spans[lo + d] = _merge([(s["start"], s["stop"]) for s in spans[lo + d]] +
                                               list(zip(a.tolist(), (a + index.size[w]).tolist(), strict=True)))
                        spans[lo + d] = [{"start": s, "stop": e} for s, e in spans[lo + d]]
                        who = np.unique(np.concatenate([index.who[index.who_at[x]: index.who_at[x + 1]] for x in np.unique(w)]))
                        items[lo + d] = sorted({*items[lo + d], *index.names[who].tolist()})
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in [*keep, "__text"]] + [
                    pa.array(n_words), pa.array(spans, span_type), pa.array(items, pa.list_(pa.string()))], names=schema.names)

        df = df.mapInArrow(run, schema)
    return df.drop("__text")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """The rows no item window occurs in, with their own columns."""
    found = contamination(docs.select("*", F.col(text).alias("__own")), benchmark, "__own",
                          keep=[c for c in docs.columns if c not in ("n_words", "spans", "items")], **how)
    return found.filter(F.size("spans") == 0).drop("n_words", "spans", "items")
