"""Best-fit packing by length patterns and non-negative least squares (operator 5).

Method (on the histogram of lengths, whose size is the sequence length, not the
corpus): lengths are grouped to at most some ``GROUPS`` + ``WIDTHS`` sections, rounded up;
patterns are all ways to fill at least ``FILL`` of a sequence with up to three
different groups, each repeated as often as ``REPEATS`` lists, the third being the largest
that still fits; non-negative least squares by active sets gives the repeat counts,
so that the patterns use up the histogram (a basic solution: no more patterns than
groups, so counts are large and rounding loses little); counts are rounded down and
limited to what is there.  Of a group the longest pieces are taken first, and a
pattern's last place takes the longest piece left that fits.  What is left, pieces
below 1 / ``CRUMBS`` of a sequence among it, is packed best-fit from the longest piece down
into the room left in the patterned sequences and into new ones.  The plan says, for
each length and rank among the pieces of that length, the sequence and the place in it.

Spark tokenises every text once, counts lengths, numbers the pieces of each length
(rank = offset of the part of the table + rank in it; parts are small ranges of rows,
so a frequent length is no single task), and looks each piece up in the plan.  The
plan has a few ten thousand entries at most, whatever the corpus.

Defined results: a null text is empty and has the end id alone.  Equal or repeated
rows are separate documents.  An empty table gives no row.  Very long texts are cut into full pieces and a rest.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import written
from .ship import ship
from .tokens import UnitTokenizer, with_end

GROUPS, WIDTHS, FILL, CRUMBS = 40, 48, 0.98, 64
#: How often a pattern may hold one of its lengths.
REPEATS = (1, 2, 3, 4, 8, 16)


def sections(histogram: dict[int, int], capacity: int) -> dict[int, list[int]]:
    """{longest: its lengths, descending}: sections of at most 1 / GROUPS of the pieces and 1 / WIDTHS of a sequence."""
    lengths = sorted(n for n in histogram if capacity // CRUMBS <= n <= capacity)
    share = sum(histogram[n] for n in lengths) / GROUPS
    out: dict[int, list[int]] = {}
    own: list[int] = []
    held = 0
    for n in reversed(lengths):
        if own and (own[0] - n > capacity // WIDTHS or held + histogram[n] > share or own[0] == capacity):
            out[own[0]], own, held = own, [], 0
        own.append(n)
        held += histogram[n]
    if own:
        out[own[0]] = own
    return out


def patterns(groups: list[int], capacity: int) -> list[tuple[tuple[int, int], ...]]:
    """((group, repeats), ...), groups descending: all that fill at least FILL of ``capacity`` as the method says."""
    up = sorted(groups)
    least = FILL * capacity
    out = []
    for i in range(len(up) - 1, -1, -1):
        for m in REPEATS:
            one = m * up[i]
            if one > capacity:
                break
            if one >= least:
                out.append(((up[i], m),))
            for j in range(min(i, bisect_right(up, capacity - one)) - 1, -1, -1):
                for k in REPEATS:
                    two = one + k * up[j]
                    if two > capacity:
                        break
                    if two >= least:
                        out.append(((up[i], m), (up[j], k)))
                    for r in REPEATS:
                        at = min(j, bisect_right(up, (capacity - two) // r)) - 1
                        if at >= 0 and two + r * up[at] >= least:
                            out.append(((up[i], m), (up[j], k), (up[at], r)))
    return out


def nnls(index: np.ndarray, count: np.ndarray, b: np.ndarray, weight: np.ndarray) -> dict[int, float]:
    """{column: x > 0} of least weighted squares |A x - b| by active sets.

    Column j of A holds ``count[j]`` at the rows ``index[j]`` (len(b) stands for none), so A is never built.
    """
    n = len(b)
    w = np.append(weight, 0.0)
    target = np.append(b, 0.0) * w

    def columns(at: list[int]) -> np.ndarray:
        a = np.zeros((n + 1, len(at)))
        for c, j in enumerate(at):
            np.add.at(a[:, c], index[j], count[j])
        return a * w[:, None]

    active: list[int] = []
    x = np.zeros(0)
    rest = target
    for _ in range(4 * n):
        gain = ((rest * w)[index] * count).sum(1)
        gain[active] = -np.inf
        j = int(np.argmax(gain))
        if gain[j] <= 1e-9 * max(1.0, float(np.abs(target).max())):
            break
        active, x = [*active, j], np.append(x, 0.0)
        while active:
            z = np.linalg.lstsq(columns(active), target, rcond=None)[0]
            low = z <= 1e-9
            if not low.any():
                x = z
                break
            step = np.min(x[low] / np.maximum(x[low] - z[low], 1e-300))
            x = x + min(1.0, step) * (z - x)
            stay = x > 1e-9
            if stay.all():  # no further step
                break
            active, x = [a for a, s in zip(active, stay.tolist(), strict=True) if s], x[stay]
        rest = target - (columns(active) @ x if active else 0.0)
    return dict(zip(active, x.tolist(), strict=True))


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number, first sequence, offset): pieces rank.. of a length go to sequence.., one each."""
    return plan_parts(histogram, capacity)[0]


def plan_parts(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """The plan, and how many of its entries come from patterns (these stand first)."""
    left = {n: c for n, c in histogram.items() if c > 0}
    used: dict[int, int] = defaultdict(int)
    rooms: dict[int, list[tuple[int, int]]] = {}  # free tokens: (first sequence, number)
    free: list[int] = []  # the keys of rooms, sorted
    out: list[tuple[int, int, int, int, int]] = []
    n_seq = 0

    def place(length: int, number: int, seq: int, offset: int) -> None:
        out.append((length, used[length], number, seq, offset))
        used[length] += number
        left[length] -= number

    def open_room(size: int, seq: int, number: int) -> None:
        if size:
            if size not in rooms:
                rooms[size] = []
                insort(free, size)
            rooms[size].append((seq, number))

    members = sections(left, capacity)
    groups = sorted(members)
    pats = patterns(groups, capacity)
    if pats:
        at = {g: i for i, g in enumerate(groups)}
        none = (len(groups), 0)
        cells = np.array([[(at[g], m) for g, m in p] + [none] * (3 - len(p)) for p in pats])
        b = np.array([sum(left[n] for n in members[g]) for g in groups], float)
        fit = nnls(cells[:, :, 0], cells[:, :, 1], b, np.array(groups) / capacity)
        lengths = sorted(n for g in groups for n in members[g])
        for j in sorted(fit, key=lambda j: (-fit[j], j)):
            slots = [g for g, m in pats[j] for _ in range(m)]
            r = int(fit[j] + 1e-6)
            while r > 0:  # pieces of equal exact lengths at a time
                taken: dict[int, int] = defaultdict(int)
                take: list[int] = []
                for i, g in enumerate(slots):
                    if i + 1 < len(slots) or not take:
                        n = next((n for n in members[g] if left[n] > taken[n]), None)
                    else:
                        n = longest_left(lengths, left, taken, capacity - sum(take))
                    if n is None:
                        break
                    taken[n] += 1
                    take.append(n)
                if len(take) < len(slots):
                    break
                k = min([r] + [left[n] // c for n, c in taken.items() if c])
                offset = 0
                for n in take:
                    place(n, k, n_seq, offset)
                    offset += n
                open_room(capacity - offset, n_seq, k)
                n_seq, r = n_seq + k, r - k
    by_pattern = len(out)
    # Best fit of the rest, longest first; equal lengths and equal rooms together.
    for n in sorted(left, reverse=True):
        while left[n]:
            nearest = bisect_left(free, n)
            if nearest == len(free):
                per = min(capacity // n, left[n])
                k = left[n] // per
                for i in range(per):
                    place(n, k, n_seq, i * n)
                open_room(capacity - per * n, n_seq, k)
                n_seq += k
                continue
            room = free[nearest]
            seq, k = rooms[room].pop()
            if not rooms[room]:
                del rooms[room], free[nearest]
            take = min(k, left[n])
            if take < k:
                open_room(room, seq + take, k - take)
            place(n, take, seq, capacity - room)
            open_room(room - n, seq, take)
    return out, by_pattern


def longest_left(lengths: list[int], left: dict[int, int], taken: dict[int, int], room: int) -> int | None:
    """The longest of the ascending ``lengths`` that fits in ``room`` and has a piece left; used up ones are taken out."""
    at = bisect_right(lengths, room) - 1
    while at >= 0:
        n = lengths[at]
        if not left[n]:
            del lengths[at]
        elif left[n] > taken[n]:
            return n
        at -= 1
    return None


def pieces_of(docs: DataFrame, tokenizer: UnitTokenizer, capacity: int, end: int, key: str = "doc_id", text: str = "text",
              with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of every document, cut at ``capacity`` tokens."""
    ship()

    def run(batches):
        for batch in batches:
            ids_of = batch.column(0)
            for lo, _hi, ids, size in tokenizer.encode(batch.column(1)):
                ids, size = with_end(ids.astype(np.uint32), size, end)
                k = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), k)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(k) - k, k)
                start = nth * capacity
                length = np.minimum(capacity, size[doc] - start)
                at = (np.cumsum(size) - size)[doc] + start
                blob = memoryview(ids).cast("B")
                part = [blob[4 * a: 4 * (a + b)] for a, b in zip(at.tolist(), length.tolist(), strict=True)]
                cols = [ids_of.take(pa.array(lo + doc)), pa.array(nth, pa.int32()), pa.array(start), pa.array(length),
                        pa.array([zlib.crc32(p) for p in part], pa.int64())]
                if with_ids:
                    cols.append(pa.array([bytes(p) for p in part], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    schema = T.StructType([docs.schema[key]] + T._parse_datatype_string("piece int, start long, length long, ids_crc32 long"
                                                                        + (", ids binary" if with_ids else "")).fields)
    return docs.select(key, text).mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: UnitTokenizer, capacity: int = 4096, end: int = 1, key: str = "doc_id", text: str = "text",
         with_ids: bool = False) -> DataFrame:
    """Pieces with their sequence_id and offset."""
    cut = written(pieces_of(docs, tokenizer, capacity, end, key, text, with_ids)
                  .withColumn("__id", F.monotonically_increasing_id()), "pieces")
    # A part is one writing task's range of rows; its counts by length number its pieces.
    cut = cut.withColumn("__part", F.expr("shiftright(__id, 33)"))
    counts = written(cut.groupBy("__part", "length").agg(F.count("*").alias("n")), "piece-lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    entries = sorted(plan(histogram, capacity))
    e_len, e_rank, e_num, e_seq, e_off = (np.array(c, np.int64) for c in (zip(*entries, strict=True) if entries else [()] * 5))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("__part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    cols = [c for c in cut.columns if not c.startswith("__")]
    inner = cut.withColumn("nth", F.row_number().over(Window.partitionBy("__part", "length").orderBy("__id")) - 1)
    ranked = inner.join(base, ["__part", "length"]).select(*cols, (F.col("base") + F.col("nth")).cast("long").alias("__rank"))
    # Sorted by (length, rank): one key, as a length is below 2**13 and ranks below 2**50.
    shift = np.int64(1) << 49
    starts = e_len * shift + e_rank

    def look_up(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("__rank").to_numpy()
            at = np.searchsorted(starts, length * shift + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in cols] + [pa.array(e_seq[at] + rank - e_rank[at]), pa.array(e_off[at])],
                                             names=[*cols, "sequence_id", "offset"])

    ship()
    schema = T.StructType([cut.schema[c] for c in cols] + T._parse_datatype_string("sequence_id long, offset long").fields)
    return ranked.mapInArrow(look_up, schema)
