from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelforge.llm import bagminhash, bytewords, dac, decontam, hmm, langid, linedup, packing, quality, shards, urls
from panelforge.llm.queries import tokenizer_path
from panelforge.llm.tokens import UnitTokenizer, with_end

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_words long, kept string, size long, score string, th string"
VOCAB = ["the", "of", "and", "river", "stone", "éa", "über", "Night", "carry", "low", "x1", "seven", "blue", "tree", "field", "wind"]


def prose(rng, n, vocab=VOCAB):
    return " ".join(rng.choice(vocab) + (rng.choice(["", "", "", ".", ","])) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    big = [f"w{i}" for i in range(4000)]
    out = []
    base = prose(rng, 300, big)
    shared = prose(rng, 60, big)
    for i in range(40):
        out.append((i, "\n".join(prose(rng, rng.randint(3, 40), big) for _ in range(5))))
    for i in range(40, 55):  # near copies of one text
        w = base.split(" ")
        for _ in range(i % 4):
            w[rng.randrange(len(w))] = "changed" + str(rng.randrange(99))
        out.append((i, " ".join(w)))
    out += [(60 + i, prose(rng, 20, big) + "\n" + shared + "\n" + prose(rng, 20, big)) for i in range(6)]
    out += [(70 + i, "An exact copy of a text\nwith two lines of words in it") for i in range(5)]
    out += [(80, None), (81, ""), (82, " \n\t\n "), (83, "one"), (84, "two words"), (85, "!!! ??"), (86, " ".join(VOCAB) * 30),
            (87, prose(rng, 20000, big)), (88, "na na " * 4000), (None, "a row without a key has words too"), (None, None)]
    out += [(90, "the very same row twice, key and all"), (90, "the very same row twice, key and all"), (90, "but this one differs in words")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    data = [(k, t, [None, "en", "de"][i % 3], [None, "s1"][i % 2], -1, "k", -2, "s", "h") for i, (k, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(5).cache()


def same(a, b):
    return Counter(map(repr, a)) == Counter(map(repr, b))


# -- helpers ------------------------------------------------------------------------------------------------------

def test_words_and_windows_match_python(rows):
    col = pa.array([t for _, t in rows])
    for lo, hi, data, offs in bytewords.pieces(col, 5000):
        h, row = bytewords.word_hashes(data, offs, bytewords.NOT_SPACE)
        flat = [(i - lo, w) for i in range(lo, hi) for w in brute.words(rows[i][1])]
        assert row.tolist() == [i for i, _ in flat]
        names = {}
        for x, (_, w) in zip(h.tolist(), flat, strict=True):
            assert names.setdefault(w, x) == x
        assert len(set(names.values())) == len(names)
        _, wr = bytewords.windows(h, row, hi - lo, 5)
        assert Counter(wr.tolist()) == Counter({i - lo: n for i in range(lo, hi) if (n := sum(brute.shingles(rows[i][1]).values()))})


# -- 1 ------------------------------------------------------------------------------------------------------------

def test_language_id_learns_and_is_defined_on_odd_rows(spark):
    rng = random.Random(1)
    parts = {"aa": ["tion", "ing", "the", "wh"], "bb": ["sch", "ung", "ö", "keit"], "cc": ["ción", "ado", "ñ", "que"]}
    make = lambda p: " ".join("".join(rng.choice(p) for _ in range(rng.randint(1, 3))) for _ in range(60))
    data = [(i, make(p), lang) for lang, p in parts.items() for i in range(80)]
    data = [(1000 * (j % 3) + i, t, lang) for j, (i, t, lang) in enumerate(data)] + [(-1, None, "aa"), (-2, "", None), (-3, "12 !?", "bb"), (None, make(parts["bb"]).upper(), None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    out = langid.identify(df, F.coalesce(F.col("doc_id") % 4 != 0, F.lit(False))).collect()
    assert len(out) == len(data)
    truth = {t: lang for _, t, lang in data if t}
    for r in out:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert 0 <= r.score <= 1 and r.lang_pred == (truth[r.text] or "bb")
    assert langid.identify(df.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# -- 2 ------------------------------------------------------------------------------------------------------------

def test_quality_counts_match_python(docs, rows):
    got = [tuple(r) for r in quality.with_stats(docs).select("doc_id", "text", *quality.STATS).collect()]
    want = []
    for k, t in rows:
        w = brute.WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if brute.WORD.search(x)]
        want.append((k, t, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines), len(lines) - len(set(lines)), brute.repeats(t)))
    assert same(got, want)


def test_quality_fences_adapt_and_reject(spark):
    rng = random.Random(2)
    big = [f"word{i}" for i in range(3000)]
    data = [(i, prose(rng, 120, big), "en", "s" + str(i % 2)) for i in range(600)]
    data += [(1000 + i, " ".join(w + "&&&" for w in prose(rng, 120, big).split()), "en", "s0") for i in range(20)]
    data += [(2000, None, None, None), (2001, "short", "xx", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r for r in quality.quality_rules(df).collect()}
    assert len(out) == len(data)
    assert sum(out[i].kept for i in range(600)) >= 594
    assert not any(out[1000 + i].kept for i in range(20)) and not out[2000].kept and not out[2001].kept
    assert quality.quality_rules(df.limit(0)).count() == 0


def test_quality_plan_is_native(docs):
    plan = quality.quality_rules(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- 3 ------------------------------------------------------------------------------------------------------------

def test_shards_are_contiguous_and_balanced(docs, rows):
    out = shards.byte_shards(docs, 6, keep=("text",)).collect()
    assert same([(r.doc_id, r.text) for r in out], rows)
    total = sum(r["size"] for r in out)
    assert total == sum(len((t or "").encode()) + 8 for _, t in rows)
    assert all(r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in out)
    ordered = sorted(out, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.global_start))
    assert [r.shard for r in ordered] == sorted(r.shard for r in out)
    at, slots = 0, Counter()
    for r in sorted(out, key=lambda r: (r.shard, r.slot)):
        assert r.global_start == at and r.slot == slots[r.shard]
        assert r.shard == min(5, (2 * at + r["size"]) * 6 // (2 * total))
        at += r["size"]
        slots[r.shard] += 1
    assert shards.byte_shards(docs.limit(0)).count() == 0


# -- 4 ------------------------------------------------------------------------------------------------------------

def test_hmm_counts_and_base_score(docs, rows):
    fit = F.coalesce(F.col("doc_id") % 5 != 0, F.lit(False))
    out = hmm.score_texts(docs, fit, keep=["doc_id", "text"]).collect()
    count = Counter()
    for k, t in rows:
        if k is not None and k % 5:
            count.update([*brute.words(t), None])
    n, v = sum(count.values()), len(count)
    want = []
    for k, t in rows:
        toks = [*brute.words(t), None]
        want.append((k, t, len(toks), sum(count[w] > 0 for w in toks), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks), 5)))
    assert same([(r.doc_id, r.text, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out], want)
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    by_text = {}
    for r in out:
        assert by_text.setdefault(r.text, round(r.score, 6)) == round(r.score, 6)
    assert hmm.score_texts(docs.limit(0), keep=["doc_id"]).count() == 0


def test_forward_and_baum_welch_against_enumeration(monkeypatch):
    monkeypatch.setattr(hmm, "N_SYMBOLS", 3)
    rng = np.random.default_rng(1)
    norm = lambda a, axis: a / a.sum(axis, keepdims=True)
    m = hmm.Model(norm(rng.random(2), 0), norm(rng.random((2, 2)), 1), norm(rng.random((3, 2)), 0))
    seqs = [[0, 1, 2, 1], [2], [1, 1, 0]]

    def paths(o):
        import itertools
        for p in itertools.product(range(2), repeat=len(o)):
            q = m.start[p[0]] * m.emit[o[0], p[0]]
            for t in range(1, len(o)):
                q *= m.move[p[t - 1], p[t]] * m.emit[o[t], p[t]]
            yield p, q
    ll = m.log_likelihood(np.concatenate([np.array(s) for s in seqs]), np.array([len(s) for s in seqs]))
    assert np.allclose(ll, [math.log(sum(q for _, q in paths(s))) for s in seqs])
    x, first = hmm.segments(np.concatenate([np.array(s) for s in seqs]), np.array([len(s) for s in seqs]))
    start, moves, emit = m.expect(x, first)
    w_start, w_moves, w_emit = np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2))
    for s in seqs:
        total = sum(q for _, q in paths(s))
        for p, q in paths(s):
            w_start[p[0]] += q / total
            for t, o in enumerate(s):
                w_emit[o, p[t]] += q / total
                if t:
                    w_moves[p[t - 1], p[t]] += q / total
    assert np.allclose(start, w_start) and np.allclose(moves, w_moves) and np.allclose(emit, w_emit)


# -- 5, 7 ---------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tok():
    return UnitTokenizer(tokenizer_path())


def whole(tok, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(tok.content)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_unit_ids_are_those_of_whole_texts(tok, rows):
    rng = random.Random(9)
    marks = ["'s", "'", "<|endoftext|>", "<|ENDOFTEXT|>", "É", "e\u0301", "=\u0338", "…", "—!", "\u00a0", "\u3000", "0", "10", "A0b", "it's", "I'LL",
             "ß", "İ", "ÀB", "x²", "٣", "\x1f", "\x7f", "中文", "🙂!", "a_b", "C++", "\u0301", "\n", "\t", " ", "  ", "don't.", "|", "<", "%%%", "THE", "the"]
    texts = [t for _, t in rows] + ["".join(rng.choice(marks) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    got = []
    for _, _, ids, size in tok.encode(pa.array(texts)):
        got += [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]
    assert got == whole(tok, texts)


def test_packing_places_every_piece_once(docs, rows, tok):
    out = packing.pack(docs, tok, capacity=64, end=1, with_ids=True).collect()
    want = Counter()
    for (k, _), ids in zip(rows, whole(tok, [t for _, t in rows]), strict=True):
        ids = [*ids, 1]
        for i in range(0, len(ids), 64):
            part = np.array(ids[i:i + 64], "<u4").tobytes()
            want[(k, i // 64, i, len(ids[i:i + 64]), zlib.crc32(part), part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in out) == want
    seqs = {}
    for r in out:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 64
    assert packing.pack(docs.limit(0), tok).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_close_to_the_lower_bound(seed):
    rng = np.random.default_rng(seed)
    sizes = np.minimum(4096, rng.lognormal(6.4, 1.0, 20000).astype(int) + 1)
    hist = {int(k): int(n) for k, n in zip(*np.unique(sizes, return_counts=True), strict=True)}
    entries = packing.plan(hist, 4096)
    n_seq = max(e[3] + e[2] for e in entries)
    assert sum(e[2] for e in entries) == len(sizes)
    assert n_seq <= math.ceil(sizes.sum() / 4096 * 1.002) + 1
    used = np.zeros(n_seq, int)
    for length, _, number, seq, _ in entries:
        used[seq: seq + number] += length
    assert used.max() <= 4096


def test_directly_addressable_codes_round_trip_and_random_access():
    rng = np.random.default_rng(0)
    for ids in (np.zeros(0, np.uint32), np.array([0]), np.array([255, 256, 65535, 65536, 2**32 - 1]), rng.integers(0, 50000, 5000), rng.integers(0, 300, 1024)):
        for bits in (4, 8):
            b = dac.Block(dac.encode(ids.astype(np.uint32), bits))
            assert b.all().tolist() == ids.tolist()
            for i in rng.integers(0, len(ids), 200 if len(ids) else 0).tolist():
                assert b.get(i) == ids[i]
    with pytest.raises(ValueError):
        dac.Block(b"nope")


def test_token_file(docs, rows, tok, monkeypatch):
    monkeypatch.setattr(dac, "BLOCK", 700)
    file = dac.write_tokens(docs, tok, end=2)
    out = sorted(dac.read_tokens(file, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id is not None for r in out] == sorted(r.doc_id is not None for r in out)
    keys = [r.doc_id for r in out if r.doc_id is not None]
    assert keys == sorted(keys)
    at = 0
    for r in out:
        assert r.start == at and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        at += r.n_tokens
    want = [(k, np.array([*ids, 2], "<u4").tobytes()) for (k, _), ids in zip(rows, whole(tok, [t for _, t in rows]), strict=True)]
    assert same([(r.doc_id, bytes(r.ids)) for r in out], want)
    assert dac.read_tokens(dac.write_tokens(docs.limit(0), tok)).count() == 0


# -- 6 ------------------------------------------------------------------------------------------------------------

def test_url_rules_and_parts(spark):
    data = [(1, "http://A.Example.COM/en/x?q#f"), (2, "https://www.example.com/en/"), (3, "http://x.net/es/1"), (4, "http://x.net/de/1"), (5, None), (6, ""),
            (7, "no scheme/path"), (8, "http://notexample.com/en/"), (9, "http://com/a"), (10, "http://b.com"), (11, "http://b.com?x=/"), (12, "a://b.com/p#/://c.net/"),
            (12, "a://b.com/p#/://c.net/"), (None, "http://é.org/" + "y" * 30000)]
    df = spark.createDataFrame(data, "page_id long, url string").withColumn("host", F.lit("clash"))
    out = {(r.page_id, r.host[:20], r.path[:10], r.rule): r.verdict for r in urls.judge_urls(df).collect()}
    for want, verdict in (((1, "a.example.com", "/en/x", "example.com/en/"), "block"), ((2, "www.example.com", "/en/", "www.example.com/en/"), "allow"),
                          ((3, "x.net", "/es/1", "net/es/"), "block"), ((8, "notexample.com", "/en/", "com/"), "allow"), ((9, "com", "/a", "com/"), "allow"),
                          ((12, "b.com", "/p", "com/"), "allow")):
        assert out[want] == verdict
    for key in ((4, "x.net", "/de/1", None), (5, "", "", None), (6, "", "", None), (7, "", "", None), (10, "b.com", "", None), (11, "b.com", "", None), (None, "é.org", "/yyyyyyyyy", None)):
        assert out[key] in ("allow", "block")
    assert urls.judge_urls(df).count() == len(data)
    assert urls.judge_urls(df.limit(0)).count() == 0
    assert {r.verdict for r in urls.judge_urls(df.filter("page_id = 4")).collect()} == {"allow"}


# -- 8 ------------------------------------------------------------------------------------------------------------

def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(4)
    n = 400
    h = bytewords.mix(np.arange(1, n + 1, dtype=np.uint64))
    wa, wb = rng.integers(0, 9, n), rng.integers(0, 9, n)
    wb = np.where(rng.random(n) < 0.6, wa, wb)
    rows, hs, ws = [], [], []
    for i, w in enumerate((wa, wb)):
        rows.append(np.full((w > 0).sum(), i))
        hs.append(h[w > 0])
        ws.append(w[w > 0])
    sig = bagminhash.signatures(np.concatenate(hs), np.concatenate(rows), np.concatenate(ws), 2, 4096)
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 4 * math.sqrt(true * (1 - true) / 4096)


def test_near_duplicate_classes_match_brute_force(docs, rows):
    out = bagminhash.near_duplicates(docs.withColumn("md5", F.lit(1))).collect()
    want = brute.classes(rows)
    import hashlib
    md5 = {hashlib.md5((t or "").encode()).hexdigest(): t or "" for _, t in rows}
    assert same([(r.doc_id, md5[r.md5], r.class_id) for r in out], [(k, t or "", want[(k, t or "")]) for k, t in rows])
    kept = bagminhash.one_of_each(docs).collect()
    assert len({(r.doc_id, r.text or "") for r in kept}) == len(kept)
    assert Counter(want[(r.doc_id, r.text or "")] for r in kept if r.doc_id is not None).most_common(1)[0][1] <= 2  # two texts of key 90
    assert kept[0].asDict().keys() == docs.first().asDict().keys()
    assert bagminhash.near_duplicates(docs.limit(0)).count() == 0


# -- 9 ------------------------------------------------------------------------------------------------------------

def test_contamination_matches_brute_force(spark, docs, rows, monkeypatch):
    t = dict((k, t) for k, t in rows if k is not None)
    cut = lambda k, a, n: " ".join((t[k] or "").split()[a:a + n])
    items = [(1, cut(3, 2, 14)), (2, cut(45, 5, 30)), (2, "two words"), (3, None), (4, "  "), (None, cut(61, 25, 12)), (5, cut(88, 0, 12)), (6, "ONE"), (7, "never there at all"),
             (8, cut(87, 500, 10) + " other"), (9, "words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = [(k, *brute.hits(x, items)) for k, x in rows]
    for limit in (1 << 25, 200):  # one block, several blocks
        monkeypatch.setattr(decontam, "BLOCK_BYTES", limit)
        out = decontam.contamination(docs, bench).collect()
        assert same([(r.doc_id, r.n_words, sum(s.stop - s.start for s in r.spans), list(r["items"])) for r in out], want)
    left = decontam.clean(docs, bench)
    assert left.columns == [c for c in docs.columns if c != "n_words"]
    assert left.count() == sum(w[2] == 0 for w in want)
    assert decontam.clean(docs, bench.limit(0)).count() == len(rows)
    assert decontam.contamination(docs.limit(0), bench).count() == 0


# -- 10 -----------------------------------------------------------------------------------------------------------

def test_line_dedup_matches_brute_force(spark, docs, rows):
    th = {r.text: r.h for r in docs.filter("text IS NOT NULL").select("text", F.xxhash64("text").alias("h")).collect()}
    want = brute.removed_lines(rows, lambda r: (r[0] is not None, r[0] or 0, th[r[1]]))
    out = linedup.dedup_lines(docs).collect()
    expect = []
    for k, t in rows:
        lines = t.split("\n") if t is not None else []
        gone = want.get((k, t), set())
        expect.append((k, None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)))
    assert same([(r.doc_id, r.text, r.n_lines, r.n_removed) for r in out], expect)
    assert sum(map(len, want.values())) > 10
    assert linedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_finds_edited_lines(spark):
    rng = random.Random(5)
    big = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        base = [rng.choice(big) for _ in range(12)]
        rows.append((2 * i, " ".join(base)))
        base[rng.randrange(12)] = "new"
        rows.append((2 * i + 1, " ".join(base) + "\n" + " ".join(rng.choice(big) for _ in range(9))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.removed_lines(rows, lambda r: r[0])
    out = {r.doc_id: r.n_removed for r in linedup.dedup_lines(docs).collect()}
    assert out == {k: len(want.get((k, t), ())) for k, t in rows} and sum(out.values()) >= 50


def test_with_end():
    ids, size = with_end(np.array([5, 6, 7], np.uint16), np.array([2, 0, 1]), 1)
    assert ids.tolist() == [5, 6, 1, 1, 7, 1] and size.tolist() == [3, 1, 2]
