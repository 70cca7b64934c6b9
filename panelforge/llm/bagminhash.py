"""Near duplicates by BagMinHash, banding and exact checks (operator 8).

Method.  A text is the multiset of its five-word shingles (words are cut at ASCII
white space, A-Z folded; a shorter text is one shingle).  Weights are discretised at
the integers: weight w holds the unit levels 1..w, arranged in rings (0,1], (1,2],
(2,4], (4,8] ...  Every (shingle, ring) runs a Poisson process whose rate is the
ring's width.  A node's first point bounds all points below it; only while that
point is earlier than the latest component of the signature is the node split in
halves, the point going to one of them by a coin of the node's width ratio and the
other half going on from there with its own process; unit levels go on point by
point, and levels above w are dropped.  Each point picks one of ``M`` components and
the earliest point wins it.  Two signatures agree in a component with probability
equal to the texts' weighted Jaccard similarity; a text costs about
(shingles + M ln M) points, not shingles x M.

``BANDS`` bands of ``M / BANDS`` components: a pair of similarity 0.8 shares a band
with probability 1 - 5e-8.  Pairs are not listed by bucket.  First, each text is
checked against one leader (the smallest node of its buckets, the one it shares most
bands with), which resolves groups of copies of any size in linear work.  Then each
bucket that holds several classes is dealt into parts of about ``PART`` texts that all ask the part's
smallest node, if the shingles that each shares with any other such text could suffice, and at least
``AGREE`` of the ``M`` signature bytes agree, so a loose group is joined by links in proportion to its texts.
Last, the texts outside the commonest class of one of their buckets ask all texts of open buckets, by an
exact prefix join on their shingles (see ``_prefix_pairs``), which loses no pair of bucket-mates at or over the threshold.
A check compares whole multisets exactly.  Classes are the connected components of the pairs
at or over the threshold.  Equal texts are one node from the start.

Shuffles: hot texts are pre-aggregated by md5; joins on buckets, leaders and md5 are
plain equi-joins that adaptive execution splits when one key is hot.

Defined results: null counts as the empty text; a text without a word is only equal
to the same text.  Null keys take part; a class's id is its least non-null key.
An empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import may_be_in
from .bytewords import NOT_SPACE, mix, occurrence, pieces, windows, word_hashes
from .components import components
from .scratch import own_tables, small_batches, written
from .ship import ship

M, BANDS, WIDTH, AGREE = 128, 32, 5, 82
#: Rounds in which a text asks a few of its bucket-mates, in parts of about so many, before the join of all that are still apart.
ROUNDS, PART = 1, 4
#: Ratio of the bounds of a size class.
CLASS = 1.05
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def shingles(data: np.ndarray, offs: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle, repeats included."""
    h, row = word_hashes(data, offs, NOT_SPACE)
    return windows(h, row, len(offs) - 1, width)


def weights(h: np.ndarray, row: np.ndarray):
    """Distinct (row, hash) with their number."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    at = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))) if len(h) else np.zeros(0, np.int64)
    return h[at], row[at], np.diff(np.append(at, len(h)))


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) / float(1 << 53)


def signatures(h: np.ndarray, row: np.ndarray, weight: np.ndarray, n_rows: int, m: int = M) -> np.ndarray:
    """(n_rows, m) winners' ids; rows without an element are all 0."""
    best = np.full(n_rows * m, np.inf)
    won = np.zeros(n_rows * m, np.uint64)
    nodes = []
    lo, hi = 0, 1
    while (take := weight > lo).any():  # one ring at a time
        k = int(take.sum())
        nodes.append((h[take], row[take], weight[take], np.full(k, lo), np.full(k, hi)))
        lo, hi = hi, hi * 2
    if not nodes:
        return won.reshape(n_rows, m)
    e, d, w, lo, hi = (np.concatenate(c) for c in zip(*nodes, strict=True))
    x, count, pending = np.zeros(len(e)), np.zeros(len(e), np.uint64), np.zeros(len(e), bool)
    while len(e):
        # The next point of each node that has none waiting.
        seed = mix(e + mix(lo.astype(np.uint64) * _A + hi.astype(np.uint64) * _B))
        draw = mix(seed + count * _C)
        x = np.where(pending, x, x - np.log(_unit(draw)) / (hi - lo))
        count = count + (~pending).astype(np.uint64)
        limit = best.reshape(n_rows, m).max(1)
        live = x < limit[d]
        e, d, w, lo, hi, x, count, seed = (v[live] for v in (e, d, w, lo, hi, x, count, seed))
        leaf = hi - lo == 1
        # Unit levels: the point counts.
        pid = mix(seed[leaf] ^ mix(count[leaf] + _A))
        slot = d[leaf] * m + (pid % np.uint64(m)).astype(np.int64)
        np.minimum.at(best, slot, x[leaf])
        win = best[slot] == x[leaf]
        won[slot[win]] = pid[win]
        # Wider nodes: split; the half that has the point keeps it waiting.
        s = ~leaf
        mid = (lo[s] + hi[s]) // 2
        left = _unit(mix(seed[s] + _B)) <= (mid - lo[s]) / (hi[s] - lo[s])
        up = mid < w[s]  # else no level of the upper half belongs to the element
        zero = np.zeros(int(s.sum()), np.uint64)
        join = lambda a, b, c: np.concatenate((a[leaf], b, c[up]))
        e, d, w, lo, hi, x, count, pending = (
            join(e, e[s], e[s]), join(d, d[s], d[s]), join(w, w[s], w[s]), join(lo, lo[s], mid), join(hi, mid, hi[s]),
            join(x, x[s], x[s]), join(count, zero, zero), join(np.zeros(len(leaf), bool), left, ~left))
    return won.reshape(n_rows, m)


def bands(sig: np.ndarray, n_bands: int = BANDS) -> np.ndarray:
    """One 64-bit key a band; bands do not share keys."""
    part = sig.reshape(len(sig), n_bands, -1)
    key = np.broadcast_to(mix(np.arange(1, n_bands + 1, dtype=np.uint64) * _C), part.shape[:2]).copy()
    for i in range(part.shape[2]):
        key = mix(key * _A + part[:, :, i])
    return key


def signature_bytes(won: np.ndarray) -> np.ndarray:
    """A byte of each component: the winner's top bits, as its low ones are the component's number."""
    return (won >> np.uint64(56)).astype(np.uint8)


def _features(batches):
    """key, md5, text -> key, md5, number of shingles, band keys."""
    for batch in batches:
        for lo, hi, data, offs in pieces(batch.column(2), 1 << 20):
            n = hi - lo
            h, row = shingles(data, offs)
            size = np.bincount(row, minlength=n)
            won = signatures(*weights(h, row), n)
            keys = bands(won)
            # A byte of each component, as eight bit planes of two longs each: components differ where one of their planes does.
            planes = np.unpackbits(signature_bytes(won)[:, :, None], axis=2).reshape(n, BANDS, M // BANDS, 8).transpose(0, 3, 2, 1)
            low = np.packbits(planes, axis=3, bitorder="little").reshape(n, -1).view(np.int64)
            has = size > 0
            at = np.concatenate(([0], np.cumsum(np.where(has, BANDS, 0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array(size, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(keys[has].ravel().view(np.int64))),
                 pa.FixedSizeListArray.from_arrays(pa.array(low.ravel()), M // 8).cast(pa.list_(pa.int64()))],
                names=["key", "md5", "size", "bands", "low"])


def _multisets(batches):
    """node, text -> node, the shingles as distinct 64-bit ids of (shingle, its number among equal ones)."""
    for batch in batches:
        for lo, hi, data, offs in pieces(batch.column(1), 1 << 20):
            h, row = shingles(data, offs)
            with np.errstate(over="ignore"):
                ids = mix(h + occurrence(row, h).astype(np.uint64) * _A)
            at = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=hi - lo)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(at), pa.array(ids.view(np.int64)))],
                                             names=["node", "items"])


def _differ(half: int) -> str:
    """SQL: the components of one half, by a bit each, whose bytes differ in x and y."""
    return "(" + " | ".join(f"(x.low[{i}] ^ y.low[{i}])" for i in range(half, M // 8, 2)) + ")"


def _alike() -> str:
    """SQL: enough signature bytes of x and y agree."""
    return f"bit_count({_differ(0)}) + bit_count({_differ(1)}) <= {M - AGREE}"


def _may_link(num: int, den: int) -> str:
    """SQL: x and y are in different classes, and their sizes and shared shingles could suffice."""
    return (f"x.comp <> y.comp AND {den} * least(x.size, y.size) >= {num} * greatest(x.size, y.size) "
            f"AND {num + den} * least(x.most, y.most) >= {num} * (x.size + y.size)")


def _open(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one class, with their class as ``comp``."""
    of = written(rows.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "bag-labelled")
    several = of.groupBy("bucket").agg(F.min("comp").alias("least"), F.max("comp").alias("most_")).filter("least <> most_").select("bucket")
    return written(of.join(several, "bucket", "left_semi"), "bag-open")


def _some_mates(rest: DataFrame, salt: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of bucket-mates that may link: each bucket is dealt into parts of about ``PART``, and all of a part
    ask its smallest node.  In its up to ``BANDS`` buckets a text asks as many others, however large its group is."""
    parts = rest.groupBy("bucket").agg(F.ceil(F.count("*") / PART).alias("parts"))
    dealt = (rest.join(parts, "bucket").withColumn("part", F.expr(f"pmod(xxhash64(node, bucket, {salt}), parts)"))
             .select("bucket", "part", F.struct("node", "size", "comp", "low", "most").alias("x")))
    heads = dealt.groupBy("bucket", "part").agg(F.min_by("x", F.col("x.node")).alias("y"))
    return (dealt.join(heads, ["bucket", "part"]).filter(f"x.node <> y.node AND {_may_link(num, den)} AND {_alike()}")
            .select(F.col("y.node").alias("a"), F.col("x.node").alias("b")).distinct())


def _size_class(size: str) -> str:
    """SQL: the size class; sizes of a class differ by a factor below ``CLASS``."""
    return f"floor(ln({size}) / {np.log(CLASS)})"


def _prefix_pairs(rest: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of ``rest`` (node, size, comp, asks) in different classes, one of which asks, that may be at num / den.

    A set-similarity join: shingles are ordered by how many of these texts have them; the first that two similar texts
    share stands early in both, as at least their overlap stands from there on.  Those of one text only come first and
    join nothing.  An asker's posting goes to the size classes that its place still allows, so that the common
    shingles of a loose group, which come late, meet no text of about the asker's size.
    """
    items = sets.join(rest.select("node"), "node", "left_semi").select("node", F.explode("items").alias("item"))
    common = items.groupBy("item").agg(F.count("*").alias("n")).filter("n > 1")
    early = (items.join(common, "item").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "item"))).alias("by_n"))
             .join(rest, "node").withColumn("first", F.expr("size - size(by_n)"))
             .withColumn("early", F.expr(f"slice(by_n, 1, cast(greatest(0, size - ceil({num} * size / {den}) + 1 - first) as int))")))
    postings = written(early.select("node", "size", "comp", "asks", "first", F.posexplode("early").alias("k", "x"))
                       .select("node", "size", "comp", "asks", F.expr("first + k").alias("place"), "x.item"), "bag-postings")
    own = postings.withColumn("class", F.expr(_size_class("size")))
    least, most = f"ceil({num} * size / {den})", f"floor({num + den} * (size - place) / {num}) - size"
    asked = (postings.filter("asks").withColumns({"least": F.expr(least), "most": F.expr(most)}).filter("least <= most")
             .withColumn("class", F.explode(F.expr(f"sequence({_size_class('least')}, {_size_class('most')})"))))
    side = F.struct("node", "size", "comp", "asks", "place")
    return (asked.select("item", "class", side.alias("x")).join(own.select("item", "class", side.alias("y")), ["item", "class"])
            .filter(f"x.comp <> y.comp AND (NOT y.asks OR x.node < y.node) AND {den} * least(x.size, y.size) >= {num} * greatest(x.size, y.size) "
                    f"AND {num + den} * least(x.size - x.place, y.size - y.place) >= {num} * (x.size + y.size)")
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) at or over num / den, exactly."""
    one = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    return (pairs.join(one, "a").join(two, "b")
            .withColumn("same", F.size(F.array_intersect("x", "y")))
            .filter(F.expr(f"{den} * same >= {num} * (size(x) + size(y) - same)")).select("a", "b"))


def _components_of_texts(docs: DataFrame, key: str, text: str, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Written tables of the rows (key, md5, ...) and of the distinct texts (md5, rep, n_copies, comp)."""
    t = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(key).alias("key"), F.md5(F.encode(t, "UTF-8")).alias("md5"), t.alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    feats = written(source.mapInArrow(_features, f"key {kind}, md5 string, size long, bands array<long>, low array<long>"), "bag-bands", keep=True)
    nodes = written(feats.groupBy("md5").agg(F.min("key").alias("rep"), F.count("*").alias("n_copies"), F.first("size").alias("size"),
                                             F.first("bands").alias("bands"), F.first("low").alias("low"))
                    .withColumn("node", F.monotonically_increasing_id()), "bag-nodes")
    # Buckets of two and more texts.
    buckets = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    leaders = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.min_by("size", "node").alias("leader_size"), F.count("*").alias("n")).filter("n > 1")
    shared = written(buckets.join(leaders.drop("n"), "bucket"), "bag-buckets")
    fits = f"{den} * least(size, leader_size) >= {num} * greatest(size, leader_size)"
    near = (shared.filter(f"node <> leader AND {fits}").groupBy("node", "leader").agg(F.count("*").alias("n"))
            .groupBy("node").agg(F.max_by("leader", F.col("n") * (1 << 45) - F.col("leader") % (1 << 44)).alias("leader")))
    first = written(near.select(F.col("leader").alias("a"), F.col("node").alias("b")), "bag-first")
    # The multisets of the texts that share a bucket, once each.
    wanted = written(nodes.select("node", "md5", "rep").join(shared.select("node").distinct(), "node", "left_semi"), "bag-wanted")
    low = lambda c: F.conv(F.substring(c, 1, 15), 16, 10).cast("long")
    texts = (source.filter(may_be_in(low("md5"), wanted.select(low("md5").alias("h")))).join(wanted, "md5")
             .filter("key <=> rep").select("node", "text"))
    sets = written(texts.mapInArrow(_multisets, "node long, items array<long>").dropDuplicates(["node"]), "bag-sets")
    links = written(_verified(first, sets, num, den), "bag-links")
    labels = components(links)
    # Bucket-mates that are still apart: first a few each, then, of the classes that these leave apart, all.
    rest = _open(shared.select("bucket", "node", "size"), labels)
    # Shingles that no other of these texts has: the most a text can share is the others.
    alone = (sets.join(rest.select("node").distinct(), "node", "left_semi").select("node", F.explode("items").alias("item"))
             .groupBy("item").agg(F.min("node").alias("node"), F.count("*").alias("n")).filter("n = 1")
             .groupBy("node").agg(F.count("*").alias("alone")))
    rest = rest.join(nodes.select("node", "low"), "node").join(alone, "node", "left")
    rest = written(rest.withColumn("most", F.expr("size - coalesce(alone, 0)")).drop("alone"), "bag-open")
    tried = first
    for salt in range(ROUNDS):
        some = written(_some_mates(rest, salt, num, den).join(tried, ["a", "b"], "left_anti"), "bag-some")
        found = written(_verified(some, sets, num, den), "bag-links")
        tried = tried.union(some)
        if not found.limit(1).count():
            break
        links = links.union(found)
        labels = components(links)
        rest = _open(rest.drop("comp"), labels)
    # Within a bucket's commonest class no pair is missing: a text asks if it is outside that of one of its buckets.
    main = (rest.groupBy("bucket", "comp").agg(F.count("*").alias("n")).groupBy("bucket")
            .agg(F.max_by("comp", F.struct("n", "comp")).alias("main")))
    rest = (rest.join(main, "bucket").groupBy("node").agg(F.first("size").alias("size"), F.first("most").alias("most"), F.first("comp").alias("comp"),
                                                          F.max(F.col("comp") != F.col("main")).alias("asks")))
    rest = written(rest.filter(f"{den} * most >= {num} * size").drop("most"), "bag-open")
    more = _prefix_pairs(rest, sets, num, den).join(tried, ["a", "b"], "left_anti")
    more = written(_verified(written(more, "bag-more"), sets, num, den), "bag-links")
    if more.limit(1).count():
        labels = components(links.union(more))
    comps = nodes.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    return feats, written(comps.select("md5", "rep", "n_copies", "comp"), "bag-classes", keep=True)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", num: int = 4, den: int = 5) -> DataFrame:
    """(key, md5, class_id, n_copies, is_first): one row a row of ``docs``.

    class_id is the least key of the class, n_copies the number of rows with the same text, is_first whether the
    row's text is the one that has it (one text a class).  num / den is the similarity threshold.
    """
    ship()
    with own_tables(), small_batches(docs.sparkSession):
        feats, comps = _components_of_texts(docs, key, text, num, den)
    ids = comps.groupBy("comp").agg(F.min(F.struct(F.col("rep").isNull().alias("no"), "rep", "md5")).alias("first"))
    classes = comps.join(ids, "comp").select("md5", F.col("first.rep").alias("class_id"), "n_copies",
                                             (F.col("md5") == F.col("first.md5")).alias("is_first"))
    return (feats.select(F.col("key").alias(key), "md5").join(classes, "md5")
            .select(key, "md5", "class_id", "n_copies", "is_first"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The row of each class whose key is the class id, with all its columns; of full repeats of it, one."""
    found = near_duplicates(docs, key, text, **how)
    stay = (found.filter(F.col("is_first") & F.col(key).eqNullSafe(F.col("class_id")))
            .select(F.col(key).alias("__key"), F.col("md5").alias("__stay")).distinct())
    tagged = docs.withColumn("__md5", F.md5(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")))
    return (tagged.join(stay, (F.col("__md5") == F.col("__stay")) & F.col(key).eqNullSafe(F.col("__key")), "left_semi")
            .dropDuplicates([key, "__md5"]).drop("__md5"))
