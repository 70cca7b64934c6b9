from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from panelforge.llm import align, queries
from panelforge.llm.bytewords import pieces
from panelforge.llm.pairtokens import PairTokenizer
from panelforge.llm.queries import tokenizer_path
from panelforge.llm.scratch import table

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "\n", " a", "a ", "a  b", "a \n b", "it's we'll I'M '  's", " x  y", "x  y　 z", "a\u0085 b", "é ñ ß ü", "ﬁ ﬁ", "a▁b", "▁",
       "<|endoftext|> <s> </s> <unk> <0x41>", "\0 \x1c a", "日本 語  です 。", "🙂 🙂🙂 x", "﻿ b", "123 45,6 $$$ ###", "tab\tword \t x", "\r\n \r\n", "x" * 300, "end  next"]


@pytest.fixture(scope="module")
def pair():
    return PairTokenizer(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    """Whole texts by tiktoken (the same vocabulary as ranks) and by sentencepiece."""
    P = public_tokenizers
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    a = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    back = {i: t for t, i in ranks.items()}

    def both(text):
        if not text:
            return [], []
        x = [(i, back[i]) for i in a.encode_ordinary(" " + text)]
        y = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            y.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        want = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == want and b"".join(t for _, t in y) == want else ([], [])
    return both


def brute_links(x, y):
    spans = []
    for side in (x, y):
        at, out = 0, []
        for i, t in side:
            out.append((i, at, at + len(t)))
            at += len(t)
        spans.append(out)
    return [(i, j) for i, a0, a1 in spans[0] for j, b0, b1 in spans[1] if max(a0, b0) < min(a1, b1)], spans


def brute_groups(spans):
    ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
    out, lo = [], 0
    for hi in ends:
        out.append("|".join(",".join(str(i) for i, a, b in side if lo < b <= hi) for side in spans))
        lo = hi
    return ";".join(out)


def brute(rows, both):
    found = []
    for k, t in rows:
        x, y = both(t)
        links, spans = brute_links(x, y)
        found.append((k, x, y, links, brute_groups(spans)))
    count = Counter(p for f in found for p in f[3])
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(k, len(x), len(y), g.count(";") + 1 if g else 0, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), g)
            for k, x, y, links, g in found], count


def test_units_give_the_libraries_ids(pair, libraries):
    texts = ODD + [" ".join(ODD), "".join(ODD[3:13]), " ".join(ODD[i % len(ODD)] for i in range(1, 200, 7) if "▁" not in ODD[i % len(ODD)])]
    for _ in range(2):  # learned, then kept
        _, _, data, offs = next(pieces(pa.array(texts), 1 << 40))
        (a, n_a), (b, n_b) = pair.piece(data, offs)
        for ids, number, side in ((a, n_a, 0), (b, n_b, 1)):
            for t, got in zip(texts, np.split(ids, np.cumsum(number)[:-1]), strict=True):
                assert got.tolist() == [i for i, _ in libraries(t)[side]], repr(t)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text(alphabet=" \n\ta'bé1.! ", max_size=40)), min_size=1, max_size=6))
def test_any_texts(pair, libraries, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    _, _, data, offs = next(pieces(pa.array(texts), 1 << 40))
    (a, n_a), (b, n_b) = pair.piece(data, offs)
    al = align.Aligned(pair, a, b, n_a, n_b)
    blob, at = al.groups()
    links, number = al.links()
    for i, t in enumerate(texts):
        x, y = libraries(t)
        want, spans = brute_links(x, y)
        mine = links[number[:i].sum(): number[:i + 1].sum()]
        assert [(int(p) // pair.n_b, int(p) % pair.n_b) for p in mine] == want
        assert blob[at[i]: at[i + 1]].decode() == brute_groups(spans)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 31, n).astype(np.uint64))
    h = align.PerfectHash(align.unpack(align.pack(align.build(keys))))
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))


def test_a_strange_pair_is_an_error():
    keys = np.arange(100, dtype=np.uint64) * np.uint64(7)
    levels = align.build(keys)
    slot = align.PerfectHash(levels).slots(keys)
    by = np.empty_like(keys)
    by[slot] = keys
    s = align.Shards(1, [(0, align.pack(levels), by.tobytes(), None)])
    assert (by[s.slots(keys)] == keys).all()
    with pytest.raises(ValueError):
        s.slots(np.array([7, 8], np.uint64))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["river", "Stone,", "éauon", "the", "of", "unbelievable", "x1", "ñandú", "haing", "thntion."]
    out = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))) for i in range(60)]
    out += [(100 + i, t) for i, t in enumerate(ODD)]
    out += [(200, None), (None, "a row without a key"), (None, None), (0, out[0][1]), (0, out[0][1])]
    return out


@pytest.mark.parametrize("shard_size, per_round", [(1 << 18, 1 << 22), (100, 1 << 22), (100, 150)])
def test_operator_equals_brute_force(spark, pair, libraries, rows, shard_size, per_round, monkeypatch):
    monkeypatch.setattr(align, "FAN", 2)
    df = spark.createDataFrame([(k, t, "x", 3) for k, t in rows], "doc_id long, text string, groups string, shard int").repartition(5)
    want, _ = brute(rows, libraries)
    out = align.align(df, pair, groups="text", shard_size=shard_size, per_round=per_round)
    assert out.columns == ["doc_id", "text", "shard", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert Counter((r[0], *r[3:]) for r in out.collect()) == Counter(want)


def test_pair_counts_and_empty_tables(spark, pair, libraries, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, counted, _, _ = align.prepared(df, pair, "text", ["doc_id"], "sha256", 500, 1 << 20)
    assert {(r[0], r[1]): r[2] for r in align.pair_counts(counted, pair.n_b).collect()} == dict(brute(rows, libraries)[1])
    assert align.align(df.limit(0), pair).collect() == []
    assert [tuple(r)[2:] for r in align.align(df.filter("doc_id = 200"), pair).collect()] == [(0,) * 6 + ("",)]
    with pytest.raises(ValueError):
        align.align(df, pair, groups="other")


def test_a_very_long_text(pair, libraries):
    text = ("river éauon " * 40_000) + "x" * 20_000
    _, _, data, offs = next(pieces(pa.array([text])))
    (a, n_a), (b, n_b) = pair.piece(data, offs)
    x, y = libraries(text)
    assert a.tolist() == [i for i, _ in x] and b.tolist() == [i for i, _ in y]


def test_query_equals_brute_force(spark, libraries):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    want = {r[0]: (*r[1:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in brute_fast(rows, libraries)}
    out = queries.QUERIES["op13_token_alignment"](spark, SF)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == want


def brute_fast(rows, both):
    """``brute`` with two pointers in place of all pairs."""
    found = []
    for k, t in rows:
        x, y = both(t)
        links, groups, i, j, a, b = [], [[[], []]], 0, 0, 0, 0
        while i < len(x) and j < len(y):
            links.append((x[i][0], y[j][0]))
            end_a, end_b = a + len(x[i][1]), b + len(y[j][1])
            if end_a <= end_b:
                groups[-1][0].append(x[i][0])
            if end_b <= end_a:
                groups[-1][1].append(y[j][0])
            if end_a == end_b:
                groups.append([[], []])
            if end_a <= end_b:
                i, a = i + 1, end_a
            if end_b <= end_a:
                j, b = j + 1, end_b
        found.append((k, len(x), len(y), links, groups[:-1]))
    count = Counter(p for f in found for p in f[3])
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(k, n, m, len(g), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
             ";".join("|".join(",".join(map(str, s)) for s in sides) for sides in g)) for k, n, m, links, g in found]
