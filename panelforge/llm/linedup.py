"""Line dedup by an exact set-similarity join (operator 10).

Meaning.  A line is the set of its words (cut at ASCII white space, A-Z folded).
Lines are ordered by document key (null first), the 64-bit hash of the text, and line
number.  A line with a word is removed if any earlier one, in any document, has Jaccard
similarity of at least num / den.  ``min_words`` (default ``MIN_WORDS``, every line with a word) lets shorter lines stay.

Method (prefix, positional and length filters).  Lines of equal sets are one node,
standing at its first line; later lines of the set are removed with no join.  A
node's words are sorted by rarity: by the logarithm of their count over the whole corpus, kept in a
sketch of ``2**SKETCH`` counters (words that share a counter count together), then by hash.  The sketch only orders
words, so it never changes the result.  Two sets can only be
similar if their first n - ceil(num/den n) + 1 words meet, so these are joined on the
word; a row stays a candidate if the sizes fit, if the places of the word leave enough
words behind it, and if the sets' masks differ in few enough bits.  A bit of a mask is the parity of the words that fall on
it, so words of both sets cancel out and each differing bit stands for one that they do not share, however long the lines are.
A mask has ``BITS`` bits; lines of more than ``NARROW`` words have a second, wider one.  Candidates are verified on whole sets.

A set so small that no other size and no other set of its size can be similar (below 4 words at 4/5) has no prefix: only
its equals match it, and they are its node already.

Large groups of similar lines: every node is first checked against the earliest node
filed under each of its prefix words; only nodes that no such leader removes go on to
the join of all others, so a group of copies costs linear work.  There a node first checks the pairs whose masks
differ least, one a round, and only what ``ROUNDS`` of these leave checks all its pairs.

The prefix words are dealt out packed: a task sends a bucket of words one row with an array a field, and the pairs
of a bucket are found on sorted arrays, a word's nodes by size.

Words are compared by 64-bit hash, in the word join by 32 bits of it (more candidates,
same result).  Defined results: null texts stay null and have no line; rows of the same
key and text are one document and are cut alike; a document that loses every line keeps
the empty text; an empty table gives no row.  Columns n_lines and n_removed replace
input columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import may_be_in
from .bytewords import NOT_SPACE, bounds, hashes, mix, pieces
from .scratch import discard, own_tables, small_batches, written
from .ship import ship

MIN_WORDS, SKETCH, BLOCK = 1, 22, 12
#: Bits of the mask, and of the second one, which lines of more than NARROW words have.
BITS, WIDE, NARROW = 96, 512, 120
#: A node's place under one of its prefix words, as dealt out; mask2 has the mask's other 32 bits.
POSTING = {"word": "<u4", "place": "<u4", "id": "<i8", "n": "<u4", "mask": "<u8", "mask2": "<u4", "asks": "u1"}
#: Bytes of text that are cut into words at once: their arrays stay in the processor's cache.
TEXT = 1 << 18
#: About so many postings are packed, or pairs compared, at once; a bucket has about so many at most, unless a word has more.
POSTINGS = 1 << 18
#: Rounds in which a node checks its likeliest pair alone.
ROUNDS = 2
#: Up to this many node ids (8 bytes each) are broadcast.
BROADCAST_ROWS = 1_000_000
#: Up to this many nodes are broadcast with their documents, to fetch their words.
BROADCAST_NODES = 250_000


def sorted_by(line: np.ndarray, n_lines: int, h: np.ndarray, rank: np.ndarray | None = None) -> np.ndarray:
    """Indices in the order of line, then rank (below 256), then hash: one sort of packed keys, if these tell all apart."""
    bits = np.uint64(max(1, int(n_lines).bit_length()))
    key = line.astype(np.uint64) << (np.uint64(64) - bits)
    key |= h >> bits if rank is None else (rank.astype(np.uint64) << (np.uint64(56) - bits)) | (h >> (np.uint64(8) + bits))
    order = np.argsort(key)
    k, x = key[order], h[order]
    if ((k[1:] == k[:-1]) & (x[1:] != x[:-1])).any():
        return np.lexsort((h, line) if rank is None else (h, rank, line))
    return order


def line_sets(data: np.ndarray, offs: np.ndarray, rank_of: np.ndarray | None = None):
    """Distinct words of every line: (word hash, line) sorted by line, rank if given, and hash, and of each line its row, number and words."""
    nl = np.flatnonzero(data == 10)
    # Lines: each row has one more than it has line feeds; in order of row, then place.
    begins = np.concatenate((offs[:-1], nl + 1))
    line_row = np.concatenate((np.arange(len(offs) - 1), np.searchsorted(offs, nl, side="right") - 1))
    order = np.lexsort((begins, line_row))
    begins, line_row = begins[order], line_row[order]
    starts, ends = bounds(data, offs, NOT_SPACE)
    h = hashes(data, starts, ends, fold=True)
    # Empty lines may begin where the next does: a word belongs to the last that begins at or before it.
    upto = np.searchsorted(starts, begins)
    n_words = np.diff(np.append(upto, len(starts)))
    line = np.repeat(np.arange(len(begins)), n_words)
    order = sorted_by(line, len(begins), h, None if rank_of is None else rank_of[(h >> np.uint64(64 - SKETCH)).astype(np.int64)])
    h, line = h[order], line[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
    first = np.searchsorted(line_row, np.arange(len(offs)))
    return h[new], line[new], line_row, np.arange(len(begins)) - first[line_row], n_words


def word_ranks(docs: DataFrame, text: str) -> np.ndarray:
    """For every counter of the sketch (a word's is the top ``SKETCH`` bits of its hash), eight times the log2 of its count.

    Counts cover all rows, however they are dealt out; a task sends counters that it met once as one bit each.  The
    sketch has a fixed size; it comes to the driver as ranks, a byte a counter.
    """
    def count(batches):
        total = np.zeros(1 << SKETCH, np.int64)
        for batch in batches:
            for _, _, data, offs in pieces(batch.column(0), TEXT):
                s, e = bounds(data, offs, NOT_SPACE)
                np.add.at(total, (hashes(data, s, e, fold=True) >> np.uint64(64 - SKETCH)).astype(np.int64), 1)
        total = total.reshape(-1, 1 << BLOCK)
        blocks = np.flatnonzero(total.any(1))
        if len(blocks):
            once = [np.packbits(total[b] == 1).tobytes() for b in blocks]
            at = [np.flatnonzero(total[b] > 1) for b in blocks]
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int32()), pa.array(once, pa.binary()), pa.array([v.astype("<u4").tobytes() for v in at], pa.binary()),
                 pa.array([total[b, v].astype("<i8").tobytes() for b, v in zip(blocks, at, strict=True)], pa.binary())], names=["block", "once", "at", "n"])

    def ranks(part: pa.Table) -> pa.Table:
        total = np.zeros(1 << BLOCK, np.int64)
        for once, at, n in zip(part["once"], part["at"], part["n"], strict=True):
            total += np.unpackbits(np.frombuffer(once.as_py(), np.uint8))
            total[np.frombuffer(at.as_py(), "<u4")] += np.frombuffer(n.as_py(), "<i8")
        out = np.minimum(255, 8 * np.log2(np.maximum(total, 1))).astype(np.uint8)
        return pa.table({"block": part["block"][:1], "ranks": pa.array([out.tobytes()], pa.binary())})

    counts = docs.select(text).mapInArrow(count, "block int, once binary, at binary, n binary")
    table = np.zeros((1 << (SKETCH - BLOCK), 1 << BLOCK), np.uint8)
    for row in counts.groupBy("block").applyInArrow(ranks, "block int, ranks binary").collect():
        table[row["block"]] = np.frombuffer(row["ranks"], np.uint8)
    return table.ravel()


def _packed(nodes: DataFrame, buckets: int) -> DataFrame:
    """The prefix words of ``nodes`` (id, n, mask, mask2, asks, prefix) in rows of (bucket, one binary a field of ``POSTING``): a word lies in one bucket.

    prefix: an array<int>, or its little-endian bytes, which pass through the plan's steps at less cost.
    """
    def pack(held):
        word, *rest = (np.concatenate(c) for c in zip(*held, strict=True))
        bucket = word % np.uint32(buckets)
        order = np.argsort((bucket.astype(np.uint64) << np.uint64(32)) | word)
        bucket = bucket[order]
        cut = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]))
        fields = [c[order] for c in (word, *rest)]
        # Bytes of one significance together: the high ones of ids, sizes and places are equal and compress away.
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[cut[:-1]], pa.int32())] +
            [pa.array([f[lo:hi].view(np.uint8).reshape(hi - lo, -1).T.tobytes() for lo, hi in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for f in fields],
            names=["bucket", *POSTING])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            node, n, mask, mask2, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            prefix = batch.column(5)
            if pa.types.is_binary(prefix.type):
                at = np.frombuffer(prefix.buffers()[1], np.int32)[prefix.offset: prefix.offset + len(prefix) + 1]
                count = np.diff(at) // 4
                word = np.frombuffer(prefix.buffers()[2] or b"", np.uint8)[at[0]: at[-1]].copy().view("<u4")
            else:
                count, word = np.diff(np.asarray(prefix.offsets)), prefix.flatten().to_numpy().view(np.uint32)
            if count.any():
                place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                held.append((word, place.astype(POSTING["place"]),
                             *[np.repeat(v.astype(POSTING[name]), count) for name, v in (("id", node), ("n", n), ("mask", mask), ("mask2", mask2), ("asks", asks))]))
                size += len(place)
            if size >= POSTINGS:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    kinds = ", ".join(f"{f} binary" for f in POSTING)
    return nodes.select("id", "n", "mask", "mask2", "asks", "prefix").mapInArrow(run, f"bucket int, {kinds}")


def _unpacked(part: pa.Table) -> dict[str, np.ndarray]:
    def field(name, kind):
        width = np.dtype(kind).itemsize
        return np.concatenate([np.ascontiguousarray(np.frombuffer(v.as_py(), np.uint8).reshape(width, -1).T).view(kind).ravel() for v in part[name]])
    return {name: field(name, kind) for name, kind in POSTING.items()}


def _pairs(packed: DataFrame, num: int, den: int, first: bool) -> DataFrame:
    """The distinct candidates (a, b, far, differ), b before a, that meet in a word.

    ``first``: every node with the word's earliest one; else those that ask with all earlier ones but that, of sizes that fit.
    differ: bits in which the masks differ.
    """
    def candidates(p, x, y):
        nx, ny = p["n"][x].astype(np.int64), p["n"][y].astype(np.int64)
        both = nx + ny
        ok = (den * np.minimum(nx, ny) >= num * np.maximum(nx, ny)) & ((num + den) * np.minimum(nx - p["place"][x], ny - p["place"][y]) >= num * both)
        x, y, both = x[ok], y[ok], both[ok]
        differ = (np.bitwise_count(p["mask"][x] ^ p["mask"][y]) + np.bitwise_count(p["mask2"][x] ^ p["mask2"][y])).astype(np.int64)
        ok = (num + den) * (both - differ) >= 2 * num * both
        x, y = x[ok], y[ok]
        return p["id"][x], p["id"][y], np.minimum(p["n"][x], p["n"][y]) > NARROW, differ[ok]

    def run(part: pa.Table) -> pa.Table:
        p = _unpacked(part)
        key = (p["word"].astype(np.uint64) << np.uint64(32)) | p["n"]
        order = np.argsort(key)
        p, key = {k: v[order] for k, v in p.items()}, key[order]
        at = np.flatnonzero(np.concatenate(([True], p["word"][1:] != p["word"][:-1])))
        size = np.diff(np.append(at, len(key)))
        lead = np.repeat(np.minimum.reduceat(p["id"], at), size)
        mine = p["id"] == lead
        found = []
        if first:
            x = np.flatnonzero(~mine)
            found.append(candidates(p, x, np.repeat(np.flatnonzero(mine), size)[x]))
        else:
            q = np.flatnonzero(~mine & p["asks"].astype(bool))
            n, word = p["n"][q].astype(np.int64), p["word"][q].astype(np.uint64) << np.uint64(32)
            lo = np.searchsorted(key, word | (-(-num * n // den)).astype(np.uint64))
            hi = np.searchsorted(key, word | np.minimum(den * n // num, (1 << 32) - 1).astype(np.uint64), side="right")
            upto, s = np.cumsum(hi - lo), 0
            while s < len(q):
                e = max(s + 1, int(np.searchsorted(upto, (upto[s - 1] if s else 0) + POSTINGS, side="right")))
                k = hi[s:e] - lo[s:e]
                x = np.repeat(q[s:e], k)
                y = np.arange(len(x)) + np.repeat(lo[s:e] - (np.cumsum(k) - k), k)
                ok = (p["id"][y] < p["id"][x]) & ~mine[y]
                found.append(candidates(p, x[ok], y[ok]))
                s = e
        a, b, far, differ = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 4
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "far": pa.array(far.astype(bool)), "differ": pa.array(differ, pa.int32())})

    return packed.groupBy("bucket").applyInArrow(run, "a long, b long, far boolean, differ int").distinct()


def _wide(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b, differ) of (a, b, far, differ) that the wide masks of long lines allow; far: both are long."""
    own = sets.filter("wide IS NOT NULL").select("id", "n", "wide")
    bits = " + ".join(f"bit_count(x.wide[{i}] ^ y.wide[{i}])" for i in range(WIDE // 64))
    far = (pairs.filter("far").join(own.select(F.col("id").alias("a"), F.struct("n", "wide").alias("x")), "a")
           .join(own.select(F.col("id").alias("b"), F.struct("n", "wide").alias("y")), "b")
           .filter(f"{num + den} * (x.n + y.n - ({bits})) >= {2 * num} * (x.n + y.n)").select("a", "b", "differ"))
    return far.union(pairs.filter("NOT far").select("a", "b", "differ"))


def duplicate_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", num: int = 4, den: int = 5,
                    min_words: int = MIN_WORDS) -> DataFrame:
    """(key, th, line_nos): the removed lines of each document that has some; th is xxhash64 of its text."""
    ship()
    source = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    rank_of = word_ranks(source, "text")

    def lines(batches):
        for batch in batches:
            for lo, _hi, data, offs in pieces(batch.column(2), TEXT):
                h, line, row, no, n_words = line_sets(data, offs, rank_of)
                ok = np.flatnonzero(n_words >= min_words)
                if not len(ok):
                    continue
                new = np.full(len(row), -1)
                new[ok] = np.arange(len(ok))
                h, line = h[new[line] >= 0], new[line[new[line] >= 0]]
                at = np.searchsorted(line, np.arange(len(ok)))
                size = np.diff(np.append(at, len(line)))
                with np.errstate(over="ignore"):
                    set_hash = mix(np.add.reduceat(mix(h + np.uint64(1)), at) + size.astype(np.uint64))
                bit = h % np.uint64(BITS)
                one = np.uint64(1) << (bit & np.uint64(63))
                mask = np.bitwise_xor.reduceat(np.where(bit < 64, one, np.uint64(0)), at)
                mask2 = np.bitwise_xor.reduceat(np.where(bit >= 64, one, np.uint64(0)), at)
                has = size > NARROW
                long = np.repeat(has, size)
                wide = np.repeat(np.arange(has.sum()), size[has]) * WIDE + ((h[long] >> np.uint64(6)) & np.uint64(WIDE - 1)).astype(np.int64)
                wide = np.bincount(wide, minlength=int(has.sum()) * WIDE) & 1
                wat = np.concatenate(([0], np.cumsum(np.where(has, WIDE // 64, 0)))).astype(np.int32)
                wide = pa.ListArray.from_arrays(pa.array(wat), pa.array(np.packbits(wide.astype(bool), bitorder="little").view(np.int64)),
                                                mask=pa.array(~has))
                least = -(-num * size // den)
                prefix = np.where((least < size) | (den * size // num > size), size - least + 1, 0)
                take = np.arange(len(h)) - np.repeat(at, size) < np.repeat(prefix, size)
                cut = np.concatenate(([0], np.cumsum(4 * prefix))).astype(np.int32)
                first = (h[take] >> np.uint64(32)).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(lo + row[ok])), batch.column(1).take(pa.array(lo + row[ok])), pa.array(no[ok], pa.int32()),
                     pa.array(set_hash.view(np.int64)), pa.array(size, pa.int32()), pa.array(mask.view(np.int64)), pa.array(mask2.view(np.int64)),
                     wide, pa.BinaryArray.from_buffers(pa.binary(), len(ok), [None, pa.py_buffer(cut), pa.py_buffer(first)])],
                    names=["key", "th", "no", "set_hash", "n", "mask", "mask2", "wide", "prefix"])

    whole = written(source.mapInArrow(lines, f"key {kind}, th long, no int, set_hash long, n int, mask long, mask2 long, wide array<long>, prefix binary"), "lines")
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sets = (whole.groupBy("set_hash").agg(F.min(F.struct("key", "th", "no")).alias("at"), F.first("n").alias("n"),
                                          F.first("mask").alias("mask"), F.first("mask2").alias("mask2"), F.first("wide").alias("wide"), F.first("prefix").alias("prefix"))
            .select("at.key", "at.th", "at.no", "n", "mask", "mask2", "wide", "prefix"))
    # Range-sorted, so that ids ascend with the lines' order.
    sets = written(sets.repartitionByRange(parts, "key", "th", "no").sortWithinPartitions("key", "th", "no")
                   .withColumn("id", F.monotonically_increasing_id()), "line-nodes")
    every = written(whole.select("key", "th", "no"), "line-places")
    discard(whole)
    # Dealt out by word, packed.  Each node with the word's earliest, if it may be similar; then those that no such one
    # removes with all others.
    total = (sets.agg(F.sum(F.length("prefix"))).first()[0] or 0) // 4
    buckets = max(parts, -(-total // POSTINGS))
    first = written(_pairs(_packed(sets.withColumn("asks", F.lit(True)), buckets), num, den, True), "line-pairs")
    first = written(_wide(first, sets, num, den), "line-pairs")
    gone = written(_similar(first, _words(first, sets, source), num, den).select("a").distinct(), "line-gone")
    asks = sets.join(_if_few(gone).select(F.col("a").alias("id"), F.lit(True).alias("out")), "id", "left").withColumn("asks", F.col("out").isNull())
    rest = written(_pairs(_packed(asks, buckets), num, den, False), "line-pairs")
    rest = written(_wide(rest, sets, num, den), "line-pairs")
    words = _words(rest, sets, source)
    # The likeliest of a node's pairs go first; those that they do not remove check the others.
    for _ in range(ROUNDS):
        best = rest.groupBy("a").agg(F.min_by("b", F.struct("differ", "b")).alias("b"))
        found = written(_similar(best, words, num, den).select("a"), "line-gone")
        gone = gone.union(found)
        rest = written(rest.join(found, "a", "left_anti").join(best, ["a", "b"], "left_anti"), "line-pairs")
    gone = written(gone.union(_similar(rest, words, num, den).select("a")).distinct(), "line-gone")
    kept = sets.select("id", "key", "th", "no").join(_if_few(gone.select(F.col("a").alias("id"))), "id", "left_anti")
    # A document's lines are bits, 64 a row: lines that are there and not kept, told by one sum and no join.
    bit = F.expr("shiftleft(1L, no & 63)")
    row = ["key", "th", F.shiftright("no", 6).alias("block")]
    bits = every.select(*row, bit.alias("here"), F.lit(0).cast("long").alias("kept")).union(
        kept.select(*row, F.lit(0).cast("long"), bit))
    removed = (bits.groupBy("key", "th", "block").agg(F.expr("bit_or(here) & ~bit_or(kept)").alias("out")).filter("out <> 0")
               .withColumn("nos", F.expr("transform(filter(sequence(0, 63), i -> bit_get(out, i) = 1), i -> 64 * block + i)")))
    return removed.groupBy("key", "th").agg(F.flatten(F.collect_list("nos")).alias("line_nos"))


def _if_few(ids: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast if it has up to ``BROADCAST_ROWS``."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def _words(pairs: DataFrame, sets: DataFrame, source: DataFrame) -> DataFrame:
    """(id, words): the whole sets of the nodes of ``pairs``."""
    ends = written(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "line-ends")
    wanted = written(sets.select("id", "key", "th", "no").join(_if_few(ends), "id", "left_semi").groupBy("key", "th")
                     .agg(F.collect_list(F.struct("id", "no")).alias("want")), "line-wanted")
    few = (wanted.agg(F.sum(F.size("want"))).first()[0] or 0) <= BROADCAST_NODES
    near = (source if few else source.filter(may_be_in(F.col("th"), wanted.select("th")))).alias("s")
    texts = near.join((F.broadcast(wanted) if few else wanted).alias("w"), F.expr("s.key <=> w.key AND s.th = w.th")).select("s.text", "w.want")

    def run(batches):
        for batch in batches:
            want, each = batch.column(1).flatten(), np.diff(np.asarray(batch.column(1).offsets))
            node, no = (want.field(i).to_numpy() for i in range(2))
            of, upto = np.repeat(np.arange(len(each)), each), np.concatenate(([0], np.cumsum(each)))
            for lo, hi, data, offs in pieces(batch.column(0), TEXT):
                h, line, row, _, _ = line_sets(data, offs)
                at = np.searchsorted(line, np.arange(len(row) + 1))
                mine = slice(upto[lo], upto[hi])
                k = np.searchsorted(row, of[mine] - lo) + no[mine]
                size = at[k + 1] - at[k]
                cut = np.concatenate(([0], np.cumsum(size)))
                words = h[np.arange(cut[-1]) + np.repeat(at[k] - cut[:-1], size)]
                yield pa.RecordBatch.from_arrays([pa.array(node[mine], pa.int64()), pa.ListArray.from_arrays(
                    pa.array(cut.astype(np.int32)), pa.array(words.view(np.int64)))], names=["id", "words"])

    whole = texts.mapInArrow(run, "id long, words array<long>").dropDuplicates(["id"])
    return written(whole, "line-words")


def _similar(pairs: DataFrame, whole: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are similar."""
    one = whole.select(F.col("id").alias("a"), F.col("words").alias("x"))
    two = whole.select(F.col("id").alias("b"), F.col("words").alias("y"))
    return (pairs.join(one, "a").join(two, "b").withColumn("same", F.size(F.array_intersect("x", "y")))
            .filter(F.expr(f"{den} * same >= {num} * (size(x) + size(y) - same)")).select("a", "b"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """All columns of ``docs`` with the text cut, plus n_lines and n_removed (longs; 0 for a null text)."""
    with own_tables(), small_batches(docs.sparkSession):
        cut = written(duplicate_lines(docs, key, text, **how), "line-cuts", keep=True).select(F.col("key").alias("__key"), F.col("th").alias("__h"), "line_nos")
    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    tagged = docs.select(*keep).withColumn("__th", F.when(F.col(text).isNotNull(), F.xxhash64(text)))
    joined = tagged.join(cut, (F.col("__th") == F.col("__h")) & F.col(key).eqNullSafe(F.col("__key")), "left")
    lines = F.split(F.col(text), "\n", -1)
    n_lines = F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"))) + 1
    new = F.when(F.col("line_nos").isNull(), F.col(text)).otherwise(
        F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(F.col("line_nos"), i)), "\n"))
    return joined.select(*[new.alias(c) if c == text else F.col(c) for c in keep],
                         F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
                         F.when(F.col("line_nos").isNull(), 0).otherwise(F.size("line_nos")).cast("long").alias("n_removed"))
