from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelforge.llm import queries, runs
from panelforge.llm.bytewords import pieces
from panelforge.llm.scratch import table

SF = "/root/testdata/sf0.001"


def brute_runs(words):
    """(start, length, period) by definition."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q):
                stretch = words[i: i + length]
                if not any(all(stretch[k] == stretch[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_left(words, found):
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def brute_text(text, key):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def in_numpy(texts):
    _, _, data, offs = next(pieces(pa.array(texts, pa.string()), 1 << 40))
    found, of, blob, offsets = runs.find(data, offs)
    by = [[] for _ in texts]
    for (s, e, q), k in zip(found.tolist(), of.tolist()):
        by[k].append((s, e - s, q))
    blob = blob.tobytes()
    return by, [blob[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(
    st.lists(st.sampled_from("ab"), max_size=60),
    st.tuples(st.lists(st.sampled_from("abcdef"), max_size=8), st.lists(st.sampled_from("abcé"), min_size=1, max_size=70), st.integers(1, 9),
              st.lists(st.sampled_from("abc"), max_size=8)).map(lambda t: t[0] + t[1] * t[2] + t[3])), min_size=1, max_size=6))
def test_runs_equal_the_definition(texts):
    by, left = in_numpy([" ".join(t) for t in texts])
    for words, got, rest in zip(texts, by, left, strict=True):
        assert got == brute_runs(words)
        assert rest == brute_left(words, got)


@pytest.mark.parametrize("period", [15, 16, 17, 31, 32, 33, 48, 64, 65, 100, 127, 128, 129, 200])
@pytest.mark.parametrize("power", [3.9, 4, 4.01, 5.3])
def test_periods_at_the_edges_of_the_scales(period, power):
    rng = random.Random(period)
    word = [rng.choice("xyz") for _ in range(period)]
    words = ["p", "q"] + [word[i % period] for i in range(int(period * power))] + ["r"] * 3
    (got,), (rest,) = in_numpy([" ".join(words)])
    assert got == brute_runs(words) and rest == brute_left(words, got)


def test_nested_runs_and_long_texts():
    inner = ["a"] * 7 + ["b", "c"]
    words = (inner * 5 + ["d"]) * 6
    (got,), _ = in_numpy([" ".join(words)])
    assert got == brute_runs(words) and {q for _, _, q in got} >= {1, 9, 46}
    long = ["na"] * 200_000
    (got,), (rest,) = in_numpy([" ".join(long)])
    assert got == [(0, 200_000, 1)] and rest == "na"
    rng = np.random.default_rng(1)
    block = [f"w{i}" for i in rng.integers(0, 10 ** 6, 20_011)]
    (got,), (rest,) = in_numpy([" ".join(block * 5)])
    assert got == [(0, 100_055, 20_011)] and rest == " ".join(block)


def test_rows_of_every_kind(spark):
    repeated = "one two three " * 5
    rows = [(1, None, "k"), (2, "", "k"), (3, " \n\t ", None), (None, repeated, "x"), (None, repeated, "x"), (5, "a  b\nc", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3)
    got = sorted(map(str, runs.periodic_runs(df).select("doc_id", "n_runs", "collapsed").collect()))
    want = [(1, 0, ""), (2, 0, ""), (3, 0, ""), (None, 1, "one two three"), (None, 1, "one two three"), (5, 0, "a b c")]
    assert got == sorted(f"Row(doc_id={k}, n_runs={n}, collapsed={c!r})" for k, n, c in want)
    extra = df.withColumnRenamed("runs", "n_words").withColumn("__best", df.doc_id)
    assert runs.periodic_runs(extra).columns == ["doc_id", "text", "n_words", "__best", "n_runs", "runs", "collapsed"]
    assert runs.digest(runs.periodic_runs(df.limit(0))).collect() == []


def test_query_equals_brute_force(spark):
    want = {}
    for r in table(spark, SF, "documents").collect():
        words = brute_text(r.text, r.doc_id)
        found = brute_runs(words)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want[r.doc_id] = (len(found), *(best or (None,) * 3), best and best[1] * 1000 // best[2],
                          hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest(),
                          hashlib.sha256(brute_left(words, found).encode()).hexdigest())
    out = queries.QUERIES["op12_periodic_runs"](spark, SF)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == want and any(v[3] and v[3] > 16 for v in want.values())
