"""Vectorised word splitting and hashing over Arrow string columns.

Words are cut on the UTF-8 bytes with numpy, so a task never builds one Python
object per word.  A word is identified by a 64-bit hash (a polynomial over a
random byte table, finished with a mixer); the chance that two different words of
a corpus of n distinct words share one is about n*n / 3.7e19.

Null texts count as empty.  Batches are cut into pieces of about ``PIECE`` bytes
(a single longer text is one piece), which bounds a worker's memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .ship import worker_cache

PIECE = 1 << 20
_R = np.uint64(0x9E3779B97F4A7C15 | 1)

#: Byte classes: True for bytes that belong to a word.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser; uint64 in and out."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * _R)
_FOLDED = _TABLE[FOLD]


def _powers(size: int) -> list[np.ndarray]:
    """r**i and r**-i modulo 2**64 for i < size; kept by the process, never in a shipped function's globals."""
    kept = worker_cache("powers")
    if "by_size" not in kept or len(kept["by_size"][0]) < size:
        inv = np.uint64(pow(int(_R), -1, 1 << 64))
        powers = []
        for base in (_R, inv):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            powers.append(np.multiply.accumulate(p))
        kept["by_size"] = powers
    return kept["by_size"]


def pieces(column: pa.Array | pa.ChunkedArray, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of each row in the bytes), about ``limit`` bytes each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo]
        lo = hi


def bounds(data: np.ndarray, offs: np.ndarray, word: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of every word: maximal runs of ``word`` bytes, cut at rows and at ``breaks``."""
    n = len(data)
    mark = np.zeros(n + 2, bool)
    mark[1:-1] = np.frombuffer(data.tobytes().translate(word.tobytes()), bool)
    turns = np.flatnonzero(mark[1:] != mark[:-1])
    cut = offs if breaks is None else np.concatenate((offs, breaks))
    cut = cut[(cut > 0) & (cut < n)]
    inside = np.unique(cut[mark[cut] & mark[cut + 1]])
    if len(inside):  # a word ends there and the next begins
        turns = np.insert(turns, np.repeat(np.searchsorted(turns, inside), 2), np.repeat(inside, 2))
    return turns[::2], turns[1::2]


def spans(data: np.ndarray, offs: np.ndarray, word: np.ndarray, breaks: np.ndarray | None = None):
    """``bounds`` and the row of every word."""
    starts, ends = bounds(data, offs, word, breaks)
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hash of each byte range; with ``fold`` A-Z count as a-z."""
    size = max(len(data), 1)
    size = 1 << (size - 1).bit_length()
    up, down = _powers(max(size, PIECE))
    acc = np.empty(len(data) + 1, np.uint64)
    acc[0] = 0
    np.take(_FOLDED if fold else _TABLE, data, out=acc[1:], mode="clip")  # bytes are in range; with a mode, out is not buffered
    acc[1:] *= up[: len(data)]
    np.cumsum(acc[1:], out=acc[1:])
    h = (acc[ends] - acc[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, offs: np.ndarray, word: np.ndarray, fold: bool = True):
    """(hash, row) of every word; with ``fold`` A-Z count as a-z."""
    if fold:
        data = FOLD[data]
    starts, ends, row = spans(data, offs, word)
    return hashes(data, starts, ends), row


def windows(h: np.ndarray, row: np.ndarray, n_rows: int, width: int):
    """Hash and row of every window of ``width`` words in a row; a row of fewer, but not none, is one window."""
    count = np.bincount(row, minlength=n_rows)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    k = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    out_row = np.repeat(np.arange(n_rows), k)
    base = np.arange(len(out_row)) - np.repeat(np.cumsum(k) - k, k) + first[out_row]
    length = np.minimum(count, width)[out_row]
    acc = np.zeros(len(out_row), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            at = base + i
            take = i < length
            acc[take] = mix(acc[take] * np.uint64(0x2545F4914F6CDD1D) + h[at[take]])
    return acc, out_row


def occurrence(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... for equal (row, hash) pairs, in the order of the input."""
    order = np.lexsort((h, row))
    r, x = row[order], h[order]
    new = np.ones(len(x), bool)
    new[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
    at = np.flatnonzero(new)
    rank = np.arange(len(x)) - np.repeat(at, np.diff(np.append(at, len(x))))
    out = np.empty(len(x), np.int64)
    out[order] = rank
    return out


def ragged(values: np.ndarray, row: np.ndarray, n_rows: int, kind: pa.DataType) -> pa.ListArray:
    """Values, already in row order, as one list a row."""
    offs = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n_rows)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values, kind))
