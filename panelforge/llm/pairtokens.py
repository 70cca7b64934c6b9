"""Token ids of texts in two public tokenizers at once, by distinct units, with every token's bytes.

A: a byte-level BPE file of the tokenizers library without normalizer or added blank,
fed with a blank and the text; special tokens' strings are plain text.  B: a
sentencepiece BPE model that adds that blank itself and escapes blanks as U+2581.
``PairTokenizer`` refuses files of another kind.

Units.  A text with its leading blank is cut before every blank whose character before
it is not white space (and known not to be: ASCII marks, letters and digits, two-byte
characters but U+0080 to U+00BF, three-byte ones outside the leads E1 to E3 and EF) and
behind which the text goes on.  A's pattern takes a blank only at the start of a token,
and only white space before it could join it; no piece of B holds U+2581 behind another
character.  So no token of either crosses a cut, and a text's ids are its units' ids.
Each distinct unit goes through both libraries once a worker, many units a call; they
are told apart by the bytes that tokens stand for.

A unit whose tokens' bytes differ from its own (B has no byte form for U+2581) leaves
its text without tokens, as do null and empty texts.
"""

from __future__ import annotations

import json

import numpy as np

from .bytewords import hashes
from .ship import worker_cache

#: Units that a worker keeps before it starts anew.
KEEP_UNITS = 1_500_000
GROUP = 2000
_ODD = "▁"


def byte_of_mark() -> dict[str, int]:
    """Byte-level BPE's printable mark of each byte: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Spelling:
    """The bytes of every id."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        return self.flat[np.repeat(self.at[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


class PairTokenizer:
    """Holds both files' content, so that executors need no file of their own."""

    def __init__(self, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as f:
            self.a = f.read()
        with open(b_path, "rb") as f:
            self.b = f.read()
        j = json.loads(self.a)
        pre = j["pre_tokenizer"] or {}
        if j["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or j["normalizer"] or not pre.get("use_regex", True):
            raise ValueError(f"{a_path}: not a plain byte-level BPE file")
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=self.b)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        if any(_ODD in p.lstrip(_ODD) for p in pieces) or any(" " in p for p in pieces) or sp.encode("a  b ", out_type=str)[0] != _ODD + "a" or \
                "".join(sp.encode("ﬁ  b ", out_type=str)) != "▁ﬁ▁▁b▁" or max(sp.get_piece_size(), len(j["model"]["vocab"])) > 65535:
            raise ValueError(f"{b_path}: pieces with a blank inside, a normalizer, or more ids than 16 bits hold")
        self.name = f"{len(self.a)}:{len(self.b)}:{hash(self.a)}:{hash(self.b)}"
        mark = byte_of_mark()
        special = {t["id"]: t["content"] for t in j.get("added_tokens", [])}
        by_id = {i: bytes(mark[c] for c in t) for t, i in j["model"]["vocab"].items() if i not in special}
        a_bytes = [by_id.get(i, special.get(i, "").encode()) for i in range(1 + max(max(by_id), max(special, default=0)))]
        b_bytes = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_unknown(i) or sp.is_control(i) else p.replace(_ODD, " ").encode()
                   for i, p in enumerate(pieces)]
        self.spelling = Spelling(a_bytes), Spelling(b_bytes)
        self.n_b = len(pieces)

    def _cache(self) -> dict:
        c = worker_cache("pairs:" + self.name)
        if "a" not in c:
            import os
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            os.environ.setdefault("RAYON_NUM_THREADS", "1")
            import sentencepiece
            from tokenizers import Tokenizer
            c["a"] = Tokenizer.from_str(self.a)
            c["a"].encode_special_tokens = True
            c["b"] = sentencepiece.SentencePieceProcessor(model_proto=self.b)
        if "keys" not in c or len(c["keys"]) > KEEP_UNITS:
            c["keys"] = np.zeros(0, np.uint64)
            c["good"] = np.zeros(0, bool)
            for side in (0, 1):
                c["at", side] = c["size", side] = np.zeros(0, np.int64)
                c["pool", side] = np.zeros(0, np.uint16)
        return c

    def encode_one(self, text: str) -> tuple[list[int], list[int]]:
        """Both libraries' ids of a blank and ``text``."""
        c = self._cache()
        return c["a"].encode(" " + text, add_special_tokens=False).ids, c["b"].encode(text, num_threads=1)

    def _learn(self, units: list[bytes], joinable: np.ndarray):
        """For each unit: the ids on either side, and whether both spell the unit."""
        got: list = [None] * len(units)
        left = [i for i in np.flatnonzero(joinable).tolist() if _ODD.encode() not in units[i]]
        alone = sorted(set(range(len(units))) - set(left))
        for lo in range(0, len(left), GROUP):
            part = left[lo: lo + GROUP]
            whole = b"".join(units[i] for i in part)
            ends = np.cumsum([len(units[i]) for i in part])
            cut = []
            for side, ids in enumerate(self.encode_one(whole.decode()[1:])):
                ids = np.array(ids, np.int64)
                spelled = self.spelling[side].spell(ids)
                after = np.cumsum(self.spelling[side].size[ids])
                at = np.searchsorted(after, ends)
                if spelled.tobytes() != whole or (after[np.minimum(at, len(after) - 1)] != ends).any():
                    break
                cut.append(np.split(ids, at[:-1] + 1))
            if len(cut) < 2:
                alone += part
                continue
            for i, x, y in zip(part, *cut, strict=True):
                got[i] = x, y, True
        none = np.zeros(0, np.int64)
        for i in alone:
            sides = [np.array(ids, np.int64) for ids in self.encode_one(units[i].decode()[1:])]
            good = all(s.spell(ids).tobytes() == units[i] for s, ids in zip(self.spelling, sides, strict=True))
            got[i] = (*sides, True) if good else (none, none, False)
        return got

    def piece(self, data: np.ndarray, offs: np.ndarray):
        """((A's ids of all texts, number by text), B's alike) for UTF-8 bytes and the texts' offsets in them."""
        n = len(offs) - 1
        c = self._cache()
        size = np.diff(offs)
        has = size > 0
        data = np.insert(data, offs[:-1][has], 0x20)
        offs = np.concatenate(([0], np.cumsum(size + has)))
        starts, ends, row = units(data, offs)
        if not len(starts):
            return tuple((np.zeros(0, np.uint16), np.zeros(n, np.int64)) for _ in range(2))
        keys, first, back = np.unique(hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(c["keys"], keys)
        new = np.ones(len(keys), bool)
        if len(c["keys"]):
            new = c["keys"][np.minimum(at, len(c["keys"]) - 1)] != keys
        if new.any():
            blob = data.tobytes()
            pick = first[new]
            got = self._learn([blob[starts[i]: ends[i]] for i in pick], safe_end(data, ends[pick], starts[pick]))
            c["good"] = np.insert(c["good"], at[new], [g[2] for g in got])
            for side in (0, 1):
                number = np.array([len(g[side]) for g in got], np.int64)
                place = len(c["pool", side]) + np.cumsum(number) - number
                c["pool", side] = np.concatenate((c["pool", side], *[g[side].astype(np.uint16) for g in got]))
                c["at", side] = np.insert(c["at", side], at[new], place)
                c["size", side] = np.insert(c["size", side], at[new], number)
            c["keys"] = np.insert(c["keys"], at[new], keys[new])
            at = np.searchsorted(c["keys"], keys)
        wrong = np.bincount(row[~c["good"][at][back]], minlength=n) > 0
        take = ~wrong[row]
        of, row = at[back][take], row[take]
        out = []
        for side in (0, 1):
            number = c["size", side][of]
            src = np.repeat(c["at", side][of] - (np.cumsum(number) - number), number) + np.arange(int(number.sum()))
            out.append((c["pool", side][src], np.bincount(row, number, n).astype(np.int64)))
        return tuple(out)


def safe_end(data: np.ndarray, at: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place ``at`` (and starts at ``floor`` or later) is known not to be white space."""
    before = lambda k: data[np.maximum(at - k, floor)]
    last, lead2, lead3 = before(1), before(2), before(3)
    wide = np.where(lead2 >= 0xC0, lead2 != 0xC2, ~np.isin(lead3, (0xE1, 0xE2, 0xE3, 0xEF)))
    return np.where(last < 0x80, (last > 0x20) & (last < 0x7F), wide) & (at > floor)


def units(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text of every unit of texts that begin with a blank."""
    blank = np.flatnonzero(data == 0x20)
    row = np.searchsorted(offs, blank, side="right") - 1
    inner = (blank > offs[row]) & (blank + 1 < offs[row + 1])
    blank, row = blank[inner], row[inner]
    cut = safe_end(data, blank, offs[row])
    full = np.flatnonzero(np.diff(offs) > 0)
    starts = np.sort(np.concatenate((offs[full], blank[cut])))
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1
