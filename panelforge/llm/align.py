"""Cross-tokenizer alignment with corpus-wide pair counts by minimal perfect hashing (operator 13).

A text's tokens in two tokenizers cover the same bytes.  Offsets where tokens of both end
cut them into groups; an A token and a B token are linked where their bytes overlap.  An
id pair's count is the number of links of the whole corpus that hold it.

Method.
1. Every text is encoded once on either side (``pairtokens``); its ids, two bytes each, its
   groups and the number of its links are written to the shared folder.
2. First pass over the ids: each task hands on its distinct pairs; the distinct pairs of
   all tasks are dealt by hash into shards of about ``SHARD`` pairs, and each shard builds
   a minimal perfect hash of its pairs: levels of bitmaps in which a pair that is alone at
   its place takes that place's rank, and the others go on to the next level.  The pairs
   are kept in hash order, so a lookup is verified.
3. Each task aligns its documents again and counts links in one dense vector a shard,
   indexed by the hash; vectors are summed in a tree of ``FAN`` parts a step.
4. Second pass: documents are re-aligned, and every link looks its pair's count up.

Shards travel to the tasks in rounds of at most ``ROUND`` pairs, which bounds what is
broadcast; each round passes over all documents and counts the links of its shards, and
a text's numbers are the sums over the rounds.  The highest count of each B id is one
number a B id.  So nothing that grows with the corpus is held in one place, and no link
is dropped.

Defined results: a null or empty text, and a text that either tokenizer cannot spell
(U+2581), has no tokens: zeros, and '' for its groups.  Equal rows get equal results, row
by row, and each counts.  Very long texts are one piece each.  The columns named in
``NEW`` replace input columns of those names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import mix, pieces
from .pairtokens import PairTokenizer
from .scratch import discard, written
from .ship import ship, worker_cache

SHARD = 1 << 18
ROUND = 1 << 22
FAN = 32
#: Distinct pairs that a task holds before it hands them on.
HELD = 1 << 21
#: Bytes of ids, both sides, in one step of a task.
STEP = 4 << 20
NEW = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "groups_sha256")

_WIDE = 6


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ASCII digits of 0 .. n - 1 at the left of rows of ``_WIDE`` bytes, and their number."""
    i = np.arange(n)
    size = 1 + sum((i >= 10 ** k).astype(np.int64) for k in range(1, _WIDE - 1))
    rows = np.zeros((n, _WIDE), np.uint8)
    for k in range(_WIDE - 1):
        rows[:, k] = np.where(k < size, 0x30 + i // 10 ** np.maximum(size - 1 - k, 0) % 10, 0)
    return rows, size


class Aligned:
    """Many texts' tokens side by side: their bytes follow each other on both sides alike."""

    def __init__(self, tok: PairTokenizer, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
        self.tok, self.a, self.b, self.n_a, self.n_b = tok, a, b, n_a, n_b
        self.end_a = np.cumsum(tok.spelling[0].size[a])
        self.end_b = np.cumsum(tok.spelling[1].size[b])
        size = int(self.end_a[-1]) + 1 if len(a) else 1
        self.at_a, self.at_b = np.zeros(size, bool), np.zeros(size, bool)
        self.at_a[self.end_a] = True
        self.at_b[self.end_b] = True
        self.both = self.at_a & self.at_b
        # Byte offset behind each text.
        self.stop = np.concatenate(([0], self.end_a))[np.cumsum(n_a)]

    def _by_text(self, at: np.ndarray) -> np.ndarray:
        upto = np.cumsum(at)[self.stop]
        return np.diff(upto, prepend=0)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(pair of every link, number by text); a pair is A id * (number of B ids) + B id.

        Between two neighbouring token ends lies one A token and one B token, and two tokens share one such stretch at most.
        """
        either = self.at_a | self.at_b
        end = np.flatnonzero(either)
        i = np.cumsum(self.at_a)[end] - self.at_a[end]
        j = np.cumsum(self.at_b)[end] - self.at_b[end]
        return self.a[i].astype(np.uint64) * np.uint64(self.tok.n_b) + self.b[j], self._by_text(either)

    def n_groups(self) -> np.ndarray:
        return self._by_text(self.both)

    def groups(self) -> tuple[bytes, np.ndarray]:
        """The texts' groups, like ``a1,a2|b1;a3|b2``, one behind the other, and the offsets of the texts in them."""
        group = np.cumsum(self.both) - self.both
        g_a, g_b = group[self.end_a], group[self.end_b]
        m = int(g_a[-1]) + 1 if len(g_a) else 0
        in_a, in_b = np.bincount(g_a, minlength=m), np.bincount(g_b, minlength=m)
        place_a = np.arange(len(self.a)) + (np.cumsum(in_b) - in_b)[g_a]
        place_b = np.arange(len(self.b)) + np.cumsum(in_a)[g_b]
        c = worker_cache("decimals")
        if "table" not in c:
            c["table"] = _decimals(65536)
        rows, size = c["table"]
        token = np.empty(len(self.a) + len(self.b), np.int64)
        token[place_a], token[place_b] = self.a, self.b
        behind = np.empty(len(token), np.uint8)
        behind[place_a] = np.where(self.both[self.end_a], 0x7C, 0x2C)
        behind[place_b] = np.where(self.both[self.end_b], 0x3B, 0x2C)
        out, long = rows[token], size[token]
        out[np.arange(len(token)), long] = behind
        upto = np.cumsum(self.n_a + self.n_b)
        last = upto[(self.n_a + self.n_b) > 0] - 1
        keep = long + 1
        keep[last] -= 1  # no mark behind a text's last group
        blob = out[np.arange(_WIDE) < keep[:, None]].tobytes()
        return blob, np.concatenate(([0], np.concatenate(([0], np.cumsum(keep)))[upto]))


# -- encoding -----------------------------------------------------------------------------------------------------


def encode(docs: DataFrame, tok: PairTokenizer, text: str, keep: list[str], groups: str) -> DataFrame:
    """``keep``, the ids (a, b) and what a text's own tokens say: n_a, n_b, n_groups, n_links and its groups."""
    q = lambda c: F.col("`" + c.replace("`", "``") + "`")
    kept = docs.select(*[q(c) for c in keep], q(text).cast("string").alias("__text"))
    out_name = "groups" if groups == "text" else "groups_sha256"
    names = [*keep, "n_a", "n_b", "n_groups", "n_links", out_name, "__a", "__b"]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in names[-7:-3]]
                          + [T.StructField(out_name, T.StringType()), T.StructField("__a", T.BinaryType()), T.StructField("__b", T.BinaryType())])

    def run(batches):
        for batch in batches:
            last = batch.num_columns - 1
            for lo, hi, data, offs in pieces(batch.column(last)):
                (a, n_a), (b, n_b) = tok.piece(data, offs)
                al = Aligned(tok, a, b, n_a, n_b)
                blob, at = al.groups()
                if groups == "text":
                    said = [blob[x:y].decode() for x, y in zip(at[:-1], at[1:], strict=True)]
                else:
                    said = [hashlib.sha256(blob[x:y]).hexdigest() if y > x else "" for x, y in zip(at[:-1], at[1:], strict=True)]
                packed = []
                for ids, number in ((a, n_a), (b, n_b)):
                    upto = np.concatenate(([0], np.cumsum(2 * number))).astype(np.int32)
                    packed.append(pa.BinaryArray.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(upto.tobytes()), pa.py_buffer(ids.tobytes())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(lo, hi - lo) for i in range(last)]
                    + [pa.array(n_a), pa.array(n_b), pa.array(al.n_groups()), pa.array(al._by_text(al.at_a | al.at_b)), pa.array(said, pa.string()), *packed], names=names)

    return kept.mapInArrow(run, schema)


def aligned(batch: pa.RecordBatch, tok: PairTokenizer) -> Iterator[tuple[int, int, Aligned]]:
    """Re-alignment of written ids: (first row, last row + 1, their alignment), about ``STEP`` bytes of ids at a time."""
    sides = []
    for name in ("__a", "__b"):
        col = batch.column(batch.schema.get_field_index(name))
        _, offs, data = col.buffers()
        offs = np.frombuffer(offs, np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
        sides.append((np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offs))
    total = sides[0][1] + sides[1][1]
    lo = 0
    while lo < batch.num_rows:
        hi = min(max(lo + 1, int(np.searchsorted(total, total[lo] + STEP, side="right")) - 1), batch.num_rows)
        (a, n_a), (b, n_b) = ((np.frombuffer(data[o[lo]: o[hi]].tobytes(), np.uint16), np.diff(o[lo: hi + 1]) // 2) for data, o in sides)
        yield lo, hi, Aligned(tok, a, b, n_a, n_b)
        lo = hi


# -- minimal perfect hash -----------------------------------------------------------------------------------------


def shard_of(pair: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(pair ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)


def _place(pair: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(pair + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(size)).astype(np.int64)


def build(pairs: np.ndarray) -> list[np.ndarray]:
    """Bitmaps of the levels, two places a pair that has come so far; ``pairs`` are distinct."""
    levels, left = [], pairs
    while len(left):
        size = 2 * len(left)
        at = _place(left, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return levels


class PerfectHash:
    """Slot 0 .. n - 1 of each of n pairs: the rank of its place among all levels' taken places."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.rank, before = [], 0
        for bits in levels:
            upto = np.cumsum(bits, dtype=np.int64)
            self.rank.append((upto - bits + before).astype(np.int32))
            before += int(upto[-1])

    def slots(self, pairs: np.ndarray) -> np.ndarray:
        """Slots, -1 for a pair that finds no place; any other pair than the n may get some slot, so verify."""
        out = np.full(len(pairs), -1, np.int64)
        left = np.arange(len(pairs))
        for level, (bits, rank) in enumerate(zip(self.levels, self.rank, strict=True)):
            if not len(left):
                break
            at = _place(pairs[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out


def pack(levels: list[np.ndarray]) -> bytes:
    head = np.array([len(levels), *[len(x) for x in levels]], np.int64).tobytes()
    return head + b"".join(np.packbits(x).tobytes() for x in levels)


def unpack(blob: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    at, out = 8 * (n + 1), []
    for size in np.frombuffer(blob, np.int64, n, 8).tolist():
        nbytes = -(-size // 8)
        out.append(np.unpackbits(np.frombuffer(blob, np.uint8, nbytes, at), count=size).astype(bool))
        at += nbytes
    return out


class Shards:
    """The hashes of some shards, with their pairs in slot order and perhaps their counts."""

    def __init__(self, shards: int, rows: list[tuple[int, bytes, bytes, bytes | None]]):
        self.n = shards
        self.number = np.full(shards, -1, np.int64)
        self.hash, first = [], [0]
        for i, (shard, blob, _, _) in enumerate(rows):
            self.number[shard] = i
            self.hash.append(PerfectHash(unpack(blob)))
        for _, _, keys, _ in rows:
            first.append(first[-1] + len(keys) // 8)
        self.ids = [shard for shard, _, _, _ in rows]
        self.first = np.array(first)
        self.pairs = np.concatenate([np.frombuffer(keys, np.uint64) for _, _, keys, _ in rows] or [np.zeros(0, np.uint64)])
        self.counts = np.concatenate([np.frombuffer(c, np.int64) for _, _, _, c in rows if c is not None] or [np.zeros(0, np.int64)])

    def slots(self, pairs: np.ndarray) -> np.ndarray:
        """Place of each pair in ``self.pairs``; -1 where its shard is not here.  A pair that no shard knows is an error."""
        if self.n == 1:
            out = self.hash[0].slots(pairs)
        else:
            number = self.number[shard_of(pairs, self.n)]
            order = np.argsort(number.astype(np.int16 if self.n < 1 << 15 else np.int64), kind="stable")
            cut = np.searchsorted(number[order], np.arange(len(self.hash) + 1))
            out = np.full(len(pairs), -1, np.int64)
            for i, h in enumerate(self.hash):
                mine = order[cut[i]: cut[i + 1]]
                slot = h.slots(pairs[mine])
                if (slot < 0).any():
                    raise ValueError("a pair is missing from its shard")
                out[mine] = self.first[i] + slot
        here = out >= 0 if self.n > 1 else slice(None)
        if len(pairs) and not np.array_equal(self.pairs[out[here]], pairs[here]):
            raise ValueError("a pair is missing from its shard")
        return out


def shard_table(tokens: DataFrame, tok: PairTokenizer, shard_size: int) -> tuple[DataFrame, int]:
    """(shard, hash, pairs) of all distinct pairs, written, and the number of shards."""
    def distinct(batches):
        held = np.zeros(0, np.uint64)
        new: list[np.ndarray] = []

        def out(x):
            for lo in range(0, len(x), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(x[lo: lo + (1 << 18)].astype(np.int64))], names=["pair"])

        for batch in batches:
            for _, _, al in aligned(batch, tok):
                new.append(np.unique(al.links()[0]))
                if sum(map(len, new)) > HELD // 2:
                    held, new = np.unique(np.concatenate((held, *new))), []
                    if len(held) > HELD:
                        yield from out(held)
                        held = np.zeros(0, np.uint64)
        yield from out(np.unique(np.concatenate((held, *new))))

    pairs = written(tokens.select("__a", "__b").mapInArrow(distinct, "pair bigint").distinct(), "pairs")
    shards = max(1, -(-pairs.count() // shard_size))

    def deal(batches):
        for batch in batches:
            p = batch.column(0).to_numpy().astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(p, shards).astype(np.int32)), batch.column(0)], names=["shard", "pair"])

    def make(group: pa.Table) -> pa.Table:
        p = np.sort(group.column("pair").to_numpy().astype(np.uint64))
        levels = build(p)
        keys = np.empty(len(p), np.uint64)
        keys[PerfectHash(levels).slots(p)] = p
        return pa.table({"shard": pa.array([group.column("shard")[0].as_py()], pa.int32()), "hash": pa.array([pack(levels)], pa.binary()),
                         "pairs": pa.array([keys.tobytes()], pa.binary()), "n": pa.array([len(p)], pa.int64())})

    table = written(pairs.mapInArrow(deal, "shard int, pair bigint").groupBy("shard").applyInArrow(make, "shard int, hash binary, pairs binary, n bigint"), "pair-hash")
    discard(pairs)
    return table, shards


def rounds_of(table: DataFrame, per_round: int) -> list[list[int]]:
    """Shard numbers dealt into rounds of at most ``per_round`` pairs (one shard at least)."""
    out, held = [], 0
    for r in table.select("shard", "n").orderBy("shard").collect():  # two numbers for every SHARD pairs
        if not out or held + r["n"] > per_round:
            out.append([])
            held = 0
        out[-1].append(r["shard"])
        held += r["n"]
    return out


def _send(table: DataFrame, shards: int, chosen: list[int], with_counts: bool):
    """A broadcast of some shards; its size is bounded by a round's pairs."""
    rows = table.filter(F.col("shard").isin(chosen)).select("shard", "hash", "pairs", *(["counts"] if with_counts else [])).orderBy("shard").collect()
    return table.sparkSession.sparkContext.broadcast((shards, [(r[0], bytes(r[1]), bytes(r[2]), bytes(r[3]) if with_counts else None) for r in rows]))


def _held(sent) -> Shards:
    """The shards of a broadcast, unpacked once a worker."""
    c = worker_cache("shards")
    if c.get("sent") is not sent.value:
        c["sent"], c["shards"] = sent.value, Shards(*sent.value)
    return c["shards"]


def count(tokens: DataFrame, tok: PairTokenizer, table: DataFrame, shards: int, rounds: list[list[int]]) -> DataFrame:
    """(shard, hash, pairs, n, counts): links by slot, dense vectors summed in a tree; written."""
    total = None
    for chosen in rounds:
        sent = _send(table, shards, chosen, False)

        def run(batches, sent=sent):
            index = _held(sent)
            vector = np.zeros(len(index.pairs), np.int64)
            for batch in batches:
                for _, _, al in aligned(batch, tok):
                    slot = index.slots(al.links()[0])
                    vector += np.bincount(slot[slot >= 0], minlength=len(vector))
            for i, shard in enumerate(index.ids):
                part = vector[index.first[i]: index.first[i + 1]]
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["shard", "counts"])

        def add(group: pa.Table) -> pa.Table:
            acc = sum(np.frombuffer(v.as_py(), np.int64) for v in group.column("counts"))
            return pa.table({"shard": group.column("shard")[:1], "part": group.column("part")[:1], "counts": pa.array([acc.tobytes()], pa.binary())})

        read = tokens.select("__a", "__b")
        parts = read.rdd.getNumPartitions()
        vectors = read.mapInArrow(run, "shard int, counts binary").withColumn("part", F.spark_partition_id())
        while True:
            parts = -(-parts // FAN)
            vectors = vectors.withColumn("part", (F.col("part") / FAN).cast("int")).groupBy("shard", "part").applyInArrow(add, "shard int, part int, counts binary")
            if parts == 1:
                break
        vectors = vectors.select("shard", "counts")
        total = vectors if total is None else total.unionByName(vectors)
    return written(table.join(total, "shard"), "pair-counts")


def highest(table: DataFrame, n_b: int) -> np.ndarray:
    """The highest count of each B id: one number a B id."""
    def run(batches):
        best = np.zeros(n_b, np.int64)
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1), strict=True):
                np.maximum.at(best, (np.frombuffer(keys.as_py(), np.uint64) % np.uint64(n_b)).astype(np.int64), np.frombuffer(counts.as_py(), np.int64))
        at = np.flatnonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(best[at])], names=["b", "best"])

    out = np.zeros(n_b, np.int64)
    for r in table.select("pairs", "counts").mapInArrow(run, "b int, best bigint").groupBy("b").agg(F.max("best").alias("best")).collect():
        out[r["b"]] = r["best"]
    return out


def pair_counts(table: DataFrame, n_b: int) -> DataFrame:
    """(id_a, id_b, count) of every linked pair, from the written shards."""
    def run(batches):
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1), strict=True):
                k = np.frombuffer(keys.as_py(), np.uint64).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((k // n_b).astype(np.int32)), pa.array((k % n_b).astype(np.int32)),
                                                  pa.array(np.frombuffer(counts.as_py(), np.int64))], names=["id_a", "id_b", "count"])
    return table.select("pairs", "counts").mapInArrow(run, "id_a int, id_b int, count bigint")


# -- the operator -------------------------------------------------------------------------------------------------


def prepared(docs: DataFrame, tok: PairTokenizer, text: str, keep: list[str], groups: str, shard_size: int, per_round: int):
    """(written ids, written shards with counts, number of shards, rounds)."""
    ship()
    tokens = written(encode(docs, tok, text, keep, groups).withColumn("__row", F.monotonically_increasing_id()), "pair-tokens")
    table, shards = shard_table(tokens, tok, shard_size)
    rounds = rounds_of(table, per_round)
    counted = count(tokens, tok, table, shards, rounds) if rounds else None
    return tokens, counted, shards, rounds


def align(docs: DataFrame, tok: PairTokenizer, text: str = "text", keep: list[str] | None = None, groups: str = "sha256",
          shard_size: int = SHARD, per_round: int = ROUND) -> DataFrame:
    """``keep`` (default: all columns) plus n_a, n_b, n_groups, n_links, n_best, count_sum and the groups of every row.

    ``groups``: "text" returns them as text in ``groups``, "sha256" their lowercase hex digest in ``groups_sha256``.
    """
    if groups not in ("text", "sha256"):
        raise ValueError("groups must be 'text' or 'sha256'")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in NEW]
    tokens, counted, shards, rounds = prepared(docs, tok, text, keep, groups, shard_size, per_round)
    q = lambda c: F.col("`" + c.replace("`", "``") + "`")
    out_name = "groups" if groups == "text" else "groups_sha256"
    order = [*[q(c) for c in keep], "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", out_name]
    if not rounds:  # no text has a token
        zero = F.lit(0).cast("long")
        return tokens.withColumn("n_best", zero).withColumn("count_sum", zero).select(*order)
    best = tokens.sparkSession.sparkContext.broadcast(highest(counted, tok.n_b))
    out = None
    for i, chosen in enumerate(rounds):
        sent = _send(counted, shards, chosen, True)

        def run(batches, sent=sent):
            index = _held(sent)
            for batch in batches:
                sums = np.zeros((2, batch.num_rows), np.int64)
                for lo, hi, al in aligned(batch, tok):
                    pairs, number = al.links()
                    slot = index.slots(pairs)
                    c = np.where(slot >= 0, index.counts[np.maximum(slot, 0)], 0)
                    top = (c > 0) & (c == best.value[(pairs % np.uint64(tok.n_b)).astype(np.int64)])
                    upto = np.concatenate(([0], np.cumsum(number)))
                    for k, x in enumerate((top, c)):
                        run_sum = np.concatenate(([0], np.cumsum(x, dtype=np.int64)))
                        sums[k, lo:hi] = run_sum[upto[1:]] - run_sum[upto[:-1]]
                cols = [batch.column(j) for j, f in enumerate(batch.schema.names) if f not in ("__a", "__b")]
                names = [f for f in batch.schema.names if f not in ("__a", "__b")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(sums[0]), pa.array(sums[1])], names=[*names, "n_best", "count_sum"])

        # The first round carries the rows, the others their row number only.
        read = tokens if i == 0 else tokens.select("__row", "__a", "__b")
        fields = [f for f in read.schema.fields if f.name not in ("__a", "__b")] + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]
        got = read.mapInArrow(run, T.StructType(fields))
        if i == 0:
            out, more = got, None
        else:
            more = got if more is None else more.unionByName(got)
    if len(rounds) > 1:
        sums = more.groupBy("__row").agg(F.sum("n_best").alias("__best"), F.sum("count_sum").alias("__sum"))
        out = (out.join(sums, "__row").withColumn("n_best", F.col("n_best") + F.col("__best"))
               .withColumn("count_sum", F.col("count_sum") + F.col("__sum")))
    return out.select(*order)
