"""Groups whose texts are mostly just below the threshold."""

from __future__ import annotations

import random

import pyarrow as pa

from panelforge.llm import bagminhash, linedup
from panelforge.llm.ship import ship

from . import brute


def loose_texts(n: int, n_words: int, edits: tuple[int, int], seed: int) -> list[str]:
    """Copies of one text with some words exchanged for words of a small vocabulary."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(n_words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for at in r.sample(range(n_words), r.randint(*edits)):
            copy[at] = r.choice(("x", "y", "z"))
        out.append(" ".join(copy))
    return out


def test_classes_of_loose_groups_match_brute_force(spark):
    texts = loose_texts(150, 60, (1, 4), 1) + loose_texts(60, 25, (0, 2), 2) + loose_texts(40, 9, (0, 1), 3)
    rows = list(enumerate(texts))
    out = bagminhash.near_duplicates(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    want = brute.classes(rows)
    assert {r.doc_id: r.class_id for r in out} == {k: want[(k, t)] for k, t in rows}
    assert len({r.class_id for r in out}) > 20


def test_prefix_pairs_hold_every_similar_pair_and_no_square(spark):
    def shingles(t):
        w = t.split()
        return {" ".join(w[i:i + 5]) for i in range(len(w) - 4)}

    texts = loose_texts(300, 146, (2, 12), 4)
    sets = [shingles(t) for t in texts]
    number = {s: i for i, s in enumerate(sorted(set().union(*sets)))}
    nodes = spark.createDataFrame([(i, len(s), i, True) for i, s in enumerate(sets)], "node long, size long, comp long, asks boolean")
    items = spark.createDataFrame([(i, [number[x] for x in s]) for i, s in enumerate(sets)], "node long, items array<long>")
    got = {(r["a"], r["b"]) for r in bagminhash._prefix_pairs(nodes, items, 4, 5).collect()}
    every = {(a, b) for b in range(len(sets)) for a in range(b)}
    similar = {(a, b) for a, b in every if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert similar and similar <= got
    assert len(got) < len(every) / 3


def test_lines_of_a_loose_group_match_brute_force_and_no_row_a_word_is_written(spark, monkeypatch):
    rows = list(enumerate(loose_texts(200, 60, (1, 9), 5) + loose_texts(60, 200, (5, 30), 6) + loose_texts(30, 5, (0, 1), 7)))
    sizes, keep = [], linedup.written

    def spy(df, name, **how):
        out = keep(df, name, **how)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(linedup, "written", spy)
    out = {r.doc_id: r.n_removed for r in linedup.dedup_lines(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    want = brute.removed_lines(rows, lambda r: r[0])
    assert out == {k: len(want.get((k, t), ())) for k, t in rows} and 20 < sum(out.values()) < len(rows)
    assert max(n for name, n in sizes if name != "line-pairs") <= len(rows)
    # The likeliest pairs go first, so few are left at the end.
    pairs = [n for name, n in sizes if name == "line-pairs"]
    assert pairs[-1] < max(pairs)


def test_packed_postings_come_back_whole(spark):
    rows = [(i << 33, 40 + i, -1 - i, i * 7, i % 2 == 0, [i - 3, -5, 2 ** 31 - 1]) for i in range(20)] + [(7, 2, 0, 0, True, [])]
    nodes = spark.createDataFrame(rows, "id long, n int, mask long, mask2 long, asks boolean, prefix array<int>").repartition(3)
    got = []
    for r in linedup._packed(nodes, 4).toArrow().to_batches():
        p = linedup._unpacked(pa.Table.from_batches([r]))
        got += zip(*(p[k].tolist() for k in linedup.POSTING), strict=True)
    want = [(w % 2 ** 32, k, i, n, m % 2 ** 64, m2, int(a)) for i, n, m, m2, a, words in rows for k, w in enumerate(words)]
    assert sorted(got) == sorted(want)


def test_masks_keep_most_pairs_of_a_loose_group_out(spark, monkeypatch):
    rows = list(enumerate(loose_texts(250, 45, (3, 9), 8)))
    pairs, keep = [], linedup.written

    def spy(df, name, **how):
        out = keep(df, name, **how)
        pairs.extend([out.count()] if name == "line-pairs" else [])
        return out

    monkeypatch.setattr(linedup, "written", spy)
    out = {r.doc_id: r.n_removed for r in linedup.dedup_lines(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    want = brute.removed_lines(rows, lambda r: r[0])
    assert out == {k: len(want.get((k, t), ())) for k, t in rows} and sum(out.values())
    words = [set(t.split()) for _, t in rows]
    similar = sum(5 * len(words[a] & words[b]) >= 4 * len(words[a] | words[b]) for b in range(len(words)) for a in range(b))
    assert max(pairs) < 3 * similar


def test_word_ranks_do_not_depend_on_how_rows_are_dealt_out(spark):
    ship()
    texts = spark.createDataFrame([(f"Often x{i} twice{i // 2} thrice{i // 3}",) for i in range(24)], "text string")
    few, many = (linedup.word_ranks(texts.repartition(n), "text") for n in (1, 24))
    assert (few == many).all()
    assert sorted(few[few > 0].tolist()) == [8] * 12 + [12] * 8 + [36]


def test_words_fetched_through_the_filter_are_the_same(spark, monkeypatch):
    ship()
    rows = [(i, f"one w{i}\n\n {i} Two {i}\nthree") for i in range(40)] * 2
    source = spark.createDataFrame(rows, "key int, text string").selectExpr("key", "xxhash64(text) AS th", "text")
    sets = source.distinct().selectExpr("key", "th", "explode(array(0, 2, 3)) AS no").selectExpr("key * 4L + no AS id", "key", "th", "no")
    pairs = spark.createDataFrame([(i * 4 + 2, i * 4 - 4) for i in range(1, 30)], "a long, b long")
    few = linedup._words(pairs, sets, source).collect()
    monkeypatch.setattr(linedup, "BROADCAST_NODES", 0)
    assert sorted(few) == sorted(linedup._words(pairs, sets, source).collect())
    assert {r.id: len(r.words) for r in few} == {i * 4 + 2: 2 for i in range(1, 30)} | {i * 4 - 4: 2 for i in range(1, 30)}
