"""Token files of directly addressable codes (operator 7).

Format of a block (all little-endian): magic ``DAC1``, u32 number of ids, u8 chunk
bits, u8 number of levels; then for each level u32 number of chunks, its chunks (one
byte each, as chunk bits are at most 8), and, but for the last level, its
continuation bitmap (bit i: chunk i goes on in the next level), padded to whole
groups of ``GROUP`` bits, and the rank directory: u32 set bits before each group.  The
chunk of the j-th continuing entry of a level is entry j of the next, so any id is
found by one rank a level: directory entry plus the set bits inside one group.  No
other entry is decoded.

A file is a Parquet table in the shared folder, one row a block: number of its part,
number in the part, first token of the block, key and size of its documents, the
block.  Executors write and read it through Spark alone, so any store works.

Documents lie in ascending key order (null keys first; equal keys by crc32 and size
of their text).  A block ends after ``BLOCK`` ids at the next document's end.  Defined
results: a null text is empty and has the end id alone; repeated rows are separate
documents; an empty table gives an empty file and no row.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ship import ship
from .scratch import written
from .tokens import UnitTokenizer, with_end

GROUP, BLOCK = 512, 1 << 18


def encode(ids: np.ndarray, bits: int = 8) -> bytes:
    levels = []
    rest = ids.astype(np.uint32)
    while True:
        on = (rest >> np.uint32(bits)) > 0
        levels.append(((rest & np.uint32((1 << bits) - 1)).astype(np.uint8), on))
        if not on.any():
            break
        rest = rest[on] >> np.uint32(bits)
    out = [b"DAC1", struct.pack("<IBB", len(ids), bits, len(levels))]
    for i, (chunk, on) in enumerate(levels):
        out += [struct.pack("<I", len(chunk)), chunk.tobytes()]
        if i < len(levels) - 1:
            padded = np.zeros(-(-len(on) // GROUP) * GROUP, bool)
            padded[: len(on)] = on
            per = padded.reshape(-1, GROUP).sum(1)
            out += [np.packbits(padded, bitorder="little").tobytes(), (np.cumsum(per) - per).astype("<u4").tobytes()]
    return b"".join(out)


class Block:
    """Reads a block in place."""

    def __init__(self, raw: bytes):
        if raw[:4] != b"DAC1":
            raise ValueError("not a block of directly addressable codes")
        self.size, self.bits, n = struct.unpack_from("<IBB", raw, 4)
        at, self.levels = 10, []
        for i in range(n):
            (k,) = struct.unpack_from("<I", raw, at)
            chunk = np.frombuffer(raw, np.uint8, k, at + 4)
            at += 4 + k
            bitmap = ranks = None
            if i < n - 1:
                g = -(-k // GROUP)
                bitmap = np.frombuffer(raw, np.uint8, g * GROUP // 8, at)
                at += len(bitmap)
                ranks = np.frombuffer(raw, "<u4", g, at)
                at += 4 * g
            self.levels.append((chunk, bitmap, ranks))

    def get(self, i: int) -> int:
        """Id i: one rank a level, nothing else is decoded."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        out = 0
        for level, (chunk, bitmap, ranks) in enumerate(self.levels):
            out |= int(chunk[i]) << (level * self.bits)
            if bitmap is None or not bitmap[i >> 3] >> (i & 7) & 1:
                break
            g = i // GROUP
            part = np.unpackbits(bitmap[g * GROUP // 8: (i >> 3) + 1], bitorder="little")
            i = int(ranks[g]) + int(part[: i - g * GROUP].sum())
        return out

    def all(self) -> np.ndarray:
        out = np.zeros(self.size, np.uint32)
        at = np.arange(self.size)
        for level, (chunk, bitmap, _) in enumerate(self.levels):
            out[at] |= chunk.astype(np.uint32) << np.uint32(level * self.bits)
            if bitmap is not None:
                at = at[np.unpackbits(bitmap, bitorder="little", count=len(chunk)).astype(bool)]
        return out




def write_tokens(docs: DataFrame, tokenizer: UnitTokenizer, end: int = 2, key: str = "doc_id", text: str = "text",
                 bits: int = 8) -> DataFrame:
    """Write the file; returns it with ``start``, the ids before each block."""
    ship()
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    t = F.coalesce(F.col(text), F.lit(""))
    ordered = (docs.select(F.col(key).alias("k"), t.alias("t"), F.crc32(F.encode(t, "UTF-8")).alias("c"), F.length(t).alias("n"))
               .repartitionByRange(parts, F.asc_nulls_first("k"), "c", "n").sortWithinPartitions(F.asc_nulls_first("k"), "c", "n")
               .select("k", "t"))
    key_type = pa.list_(pa.int64())

    def run(batches):
        from pyspark import TaskContext
        part, block = TaskContext.get().partitionId(), 0
        held, keys, sizes = [], [], []
        for batch in batches:
            names = batch.column(0).to_pylist()
            for lo, hi, ids, size in tokenizer.encode(batch.column(1)):
                ids, size = with_end(ids, size, end)
                upto = np.cumsum(size)
                a = 0
                while a < len(size):
                    room = BLOCK - sum(len(h) for h in held)
                    before = upto[a - 1] if a else 0
                    b = min(len(size), int(np.searchsorted(upto, before + room)) + 1)
                    held.append(ids[before: upto[b - 1]])
                    keys += names[lo + a: lo + b]
                    sizes += size[a:b].tolist()
                    a = b
                    if sum(len(h) for h in held) >= BLOCK:
                        yield out(part, block, held, keys, sizes)
                        block, held, keys, sizes = block + 1, [], [], []
        if keys:
            yield out(part, block, held, keys, sizes)

    def out(part, block, held, keys, sizes):
        ids = np.concatenate(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([len(ids)], pa.int64()),
             pa.array([keys], key_type), pa.array([sizes], pa.list_(pa.int32())), pa.array([encode(ids, bits)], pa.binary())],
            names=["part", "block", "n_ids", "keys", "sizes", "body"])

    if not isinstance(docs.schema[key].dataType, T.LongType):
        ordered = ordered.withColumn("k", F.col("k").cast("long"))
    file = written(ordered.mapInArrow(run, "part int, block int, n_ids long, keys array<long>, sizes array<int>, body binary"), "tokens")
    return with_starts(file)


def with_starts(file: DataFrame) -> DataFrame:
    """Prefix sums: over the parts (a bounded number of rows), then over the blocks of each part."""
    totals = file.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = written(totals.select("part", F.coalesce(F.sum("ids").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")), "token-parts")
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (file.select("part", "block", "n_ids").withColumn("upto", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
              .join(F.broadcast(before), "part").select("part", "block", (F.col("base") + F.col("upto")).alias("start")))
    return file.join(starts, ["part", "block"])


def read_tokens(file: DataFrame, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32[, ids]) of every document, decoded from the file's blocks."""
    ship()

    def run(batches):
        for batch in batches:
            for keys, sizes, start, body in zip(*(batch.column(c) for c in ("keys", "sizes", "start", "body")), strict=True):
                ids = Block(body.as_py()).all().astype("<u4")
                sizes = np.array(sizes.as_py(), np.int64)
                first = np.cumsum(sizes) - sizes
                blob = memoryview(ids).cast("B")
                part = [blob[4 * a: 4 * (a + b)] for a, b in zip(first.tolist(), sizes.tolist(), strict=True)]
                cols = [pa.array(keys.as_py(), pa.int64()), pa.array(start.as_py() + first), pa.array(sizes),
                        pa.array([zlib.crc32(p) for p in part], pa.int64())]
                if with_ids:
                    cols.append(pa.array([bytes(p) for p in part], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[key, "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    return (file.select("keys", "sizes", "start", "body")
            .mapInArrow(run, f"`{key}` long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids))


def open_tokens(spark: SparkSession, path: str) -> DataFrame:
    """A file written earlier, with the blocks' starts."""
    return with_starts(spark.read.parquet(path))
