"""Token ids of whole texts with a public tokenizer file, by distinct word units.

The tokenizer drops white space and cuts a text by a pattern before it merges, so
its ids are those of its units, one after another.  Each distinct unit goes through
the tokenizers library once a worker (many units a call, separated by the one-token
word ``0``); texts are then put together from the units' ids with numpy.

Where a unit may end without changing any id: at ASCII white space always; between
ASCII letters, digits and marks where both neighbours are ASCII, unless the word has
an apostrophe (contractions are one token pattern), a ``<|`` (special tokens) or a
byte below 0x20.  ASCII capitals are folded in units without ``<|``: the tokenizer
lowers them itself.  ``UnitTokenizer`` refuses files of another kind.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa

from .bytewords import FOLD, NOT_SPACE, hashes, pieces, spans
from .ship import worker_cache

#: Units that a worker keeps before it starts anew.
KEEP_UNITS = 1_500_000
_KIND = np.zeros(256, np.uint8)  # 0 mark, 1 letter, 2 digit, 3 not ASCII
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = 1
_KIND[0x30:0x3A] = 2
_KIND[0x80:] = 3


class UnitTokenizer:
    """Holds the tokenizer file's content, so that executors need no file of their own."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.content = f.read()
        j = json.loads(self.content)
        kinds = [n.get("type") for n in (j["normalizer"] or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or j["model"].get("end_of_word_suffix") != "</w>" or j["model"]["type"] != "BPE":
            raise ValueError(f"{path}: units are only known to be safe for lower-casing BPE files with word ends")
        self.name = f"{len(self.content)}:{hash(self.content)}"

    def __getstate__(self):
        return {"content": self.content, "name": self.name}

    def _cache(self) -> dict:
        c = worker_cache("units:" + self.name)
        if "tok" not in c:
            import os
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            os.environ.setdefault("RAYON_NUM_THREADS", "1")
            from tokenizers import Tokenizer
            c["tok"] = Tokenizer.from_str(self.content)
            c["zero"] = c["tok"].encode("0", add_special_tokens=False).ids[0]
        if "keys" not in c or len(c["keys"]) > KEEP_UNITS:
            c["keys"] = np.zeros(0, np.uint64)
            c["at"] = c["size"] = np.zeros(0, np.int64)
            c["pool"] = np.zeros(0, np.uint16 if c["tok"].get_vocab_size() <= 65536 else np.uint32)
        return c

    def _learn(self, c: dict, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, number by unit)."""
        odd = [i for i, u in enumerate(units) if "0" in u or "<|" in u]
        left = [i for i in range(len(units)) if i not in set(odd)] if odd else list(range(len(units)))
        got: list = [None] * len(units)
        for lo in range(0, len(left), 2000):
            part = left[lo: lo + 2000]
            ids = np.array(c["tok"].encode_batch_fast([" 0 ".join(units[i] for i in part)], add_special_tokens=False)[0].ids, np.int64)
            cuts = np.flatnonzero(ids == c["zero"])
            if len(cuts) != len(part) - 1:
                raise AssertionError("unit separators were lost")
            for i, a, b in zip(part, np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(ids)])), strict=True):
                got[i] = ids[a:b]
        if odd:
            for i, e in zip(odd, c["tok"].encode_batch_fast([units[i] for i in odd], add_special_tokens=False), strict=True):
                got[i] = np.array(e.ids, np.int64)
        return np.concatenate(got) if got else np.zeros(0, np.int64), np.array([len(g) for g in got], np.int64)

    def piece(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number by text) for UTF-8 bytes and the texts' offsets in them."""
        n = len(offs) - 1
        c = self._cache()
        starts, ends, row = spans(data, offs, NOT_SPACE)
        if not len(starts):
            return np.zeros(0, c["pool"].dtype), np.zeros(n, np.int64)
        # Words that must stay whole.
        bad = np.flatnonzero((data == 0x27) | (data < 0x20) & NOT_SPACE[data])
        pair = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
        whole = np.zeros(len(starts), bool)
        raw = np.zeros(len(starts), bool)
        for at, mark in ((bad, whole), (pair, raw)):
            if len(at):
                w = np.searchsorted(starts, at, side="right") - 1
                mark[w[(w >= 0) & (at < ends[np.maximum(w, 0)])]] = True
        whole |= raw
        kind = _KIND[data]
        edge = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] != 3) & (kind[:-1] != 3) & NOT_SPACE[data[1:]] & NOT_SPACE[data[:-1]]) + 1
        if whole.any() and len(edge):
            edge = edge[~whole[np.searchsorted(starts, edge, side="right") - 1]]
        starts, ends, row = spans(data, offs, NOT_SPACE, edge)
        folded = FOLD[data]
        if raw.any():  # special tokens are matched before lower-casing
            w0, w1, _ = spans(data, offs, NOT_SPACE)
            for a, b in zip(w0[raw], w1[raw], strict=True):
                folded[a:b] = data[a:b]
        keys, first, back = np.unique(hashes(folded, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(c["keys"], keys)
        new = np.ones(len(keys), bool)
        if len(c["keys"]):
            new = c["keys"][np.minimum(at, len(c["keys"]) - 1)] != keys
        if new.any():
            blob = folded.tobytes()
            units = [blob[starts[i]: ends[i]].decode("utf-8", "replace") for i in first[new]]
            ids, size = self._learn(c, units)
            place = len(c["pool"]) + np.cumsum(size) - size
            c["pool"] = np.concatenate((c["pool"], ids.astype(c["pool"].dtype)))
            c["keys"], c["at"], c["size"] = (np.insert(old, at[new], more) for old, more in (
                (c["keys"], keys[new]), (c["at"], place), (c["size"], size)))
            at = np.searchsorted(c["keys"], keys)
        size = c["size"][at][back]
        src = np.repeat(c["at"][at][back] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return c["pool"][src], np.bincount(row, size, n).astype(np.int64)

    def encode(self, column: pa.Array):
        """Yields (first row, last row + 1, ids, number by row) for pieces of a string column; null is empty."""
        for lo, hi, data, offs in pieces(column):
            ids, size = self.piece(data, offs)
            yield lo, hi, ids, size


def with_end(ids: np.ndarray, size: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end`` to every sequence."""
    at = np.cumsum(size)
    return np.insert(ids, at, end), size + 1
