from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

from panelforge.llm import quality, urls
from panelforge.llm.scratch import written


def document(rng, words, symbol_share=0.0, repeated_lines=0, phrase=0):
    """About 140 words in 20 lines; a share of words with symbols, repeated lines, and a phrase said twice ``phrase`` times."""
    lines = [" ".join(rng.choice(words) + ("&&" if rng.random() < symbol_share else "") for _ in range(7)) for _ in range(20)]
    lines += [lines[0]] * repeated_lines
    said = " ".join(rng.choice(words) for _ in range(3))
    return "\n".join(lines + [f"{said} {rng.choice(words)}{i}" for i in range(phrase)])


def two_sources(spark, n=250):
    rng = random.Random(4)
    short, long = [f"w{i}" for i in range(900)], [f"longerword{i}" for i in range(900)]
    data = [(i, document(rng, short), "en", "plain") for i in range(n)]
    data += [(n + i, document(rng, long, 0.03 * (i % 3), i % 3, i % 4), "en", "noisy") for i in range(n)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string")


def test_every_measure_gets_its_own_fence_by_source(spark):
    docs = two_sources(spark)
    stats = written(quality.with_stats(docs), "stats")
    got = {r.grp_source: r for r in quality.fences(quality.sketches(stats)).collect()}
    for m in quality.RULES:
        assert got["plain"][f"{m}_hi"] < got["noisy"][f"{m}_hi"], m
    # What is common in one source is an outlier in the other.
    out = quality.quality_rules(docs).filter("source = 'noisy'")
    assert out.filter("kept").count() >= 0.95 * out.count()
    rng = random.Random(8)
    odd = document(rng, [f"w{i}" for i in range(900)], 0.3, 0, 0)
    more = docs.union(spark.createDataFrame([(5000, odd, "en", "plain"), (5001, odd, "en", "plain")], docs.schema))
    verdict = {r.doc_id: r.kept for r in quality.quality_rules(more).collect()}
    assert not verdict[5000] and not verdict[5001] and sum(verdict[i] for i in range(250)) >= 247


def test_fences_match_a_plain_statement(spark):
    def low(v):
        s = max(0, v.bit_length() - quality.BITS)
        return v >> s << s

    table = written(quality.with_stats(two_sources(spark, 60)), "stats")
    stats = table.collect()
    ratio = {m: [(r.source, low(rule[2] * r[rule[0]] // r[rule[1]])) for r in stats if not r.base_failed] for m, rule in quality.RULES.items()}

    def own(values, rule):
        v = sorted(values)
        q1, q2, q3 = (v[-(-len(v) * p // 4) - 1] for p in (1, 2, 3))
        wide = rule[4] * (q3 - q1) if rule[3] == "quartiles" else math.floor(rule[4] * float(sum(abs(x - q2) for x in v)) / len(v))
        return q2 + wide + rule[5], len(v)

    got = {r.grp_source: r for r in quality.fences(quality.sketches(table)).collect()}
    for m, rule in quality.RULES.items():
        top, n = own([v for _, v in ratio[m]], rule)
        lang = math.floor((n * float(top) + quality.PRIOR * float(top)) / (n + quality.PRIOR))
        for source in ("plain", "noisy"):
            mine, k = own([v for s, v in ratio[m] if s == source], rule)
            assert got[source][f"{m}_hi"] == math.floor((k * float(mine) + quality.PRIOR * float(lang)) / (k + quality.PRIOR)), (m, source)


def test_a_value_on_the_fence_is_kept_and_long_texts_are_whole(spark):
    fence = spark.createDataFrame([("en", "s", 0, 9000, None, 0, None, 0, None, 0)],
                                  "grp_lang string, grp_source string, mean_word_lo long, mean_word_hi long, symbols_lo long, symbols_hi long, "
                                  "dup_lines_lo long, dup_lines_hi long, repeats_lo long, repeats_hi long")
    text = " ".join(f"w{i:08d}" for i in range(100))  # mean_word is 9000
    stats = quality.with_stats(spark.createDataFrame([(1, text, "en", "s"), (2, text + "x", "en", "s"), (3, text + " &", "en", "s")],
                                                     "doc_id long, text string, lang string, source string"))
    assert {r.doc_id: r.kept for r in quality.judge(stats, fence).collect()} == {1: True, 2: False, 3: False}  # 2: 9010
    rng = random.Random(1)
    words = [f"w{rng.randrange(80)}" for _ in range(200_000)]
    tri = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    n = Counter(tri)
    want = len({p for i, g in enumerate(tri) if n[g] > 1 for p in (i, i + 1, i + 2)})
    assert quality.with_stats(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first().n_repeat_words == want


def plain_scores(rows):
    """{url: floor of the mean llr}: Witten-Bell interpolated contexts of 2, 1 and 0 characters, in plain Python."""
    padded = {u: "^^" + re.sub(r"[^a-z0-9./?=&#%:_-]", "*", u.split("://", 1)[1].lower()) + "$" for u, _ in rows}
    counts = {label: [defaultdict(Counter) for _ in range(3)] for label in ("allow", "block")}
    for u, label in rows:
        s = padded[u]
        for i in range(2, len(s)):
            for k in range(3):
                if label:
                    counts[label][k][s[i - k: i]][s[i]] += 1

    def prob(label, ab, c):
        p = (counts[label][0][""][c] + 1.0) / (sum(counts[label][0][""].values()) + 49)
        for k in (1, 2):
            seen = counts[label][k].get(ab[2 - k:])
            if seen:
                p = (seen[c] + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p

    out = {}
    for u, s in padded.items():
        llr = [round(1e6 * (math.log(prob("allow", s[i - 2: i], s[i])) - math.log(prob("block", s[i - 2: i], s[i])))) for i in range(2, len(s))]
        out[u] = math.floor(sum(llr) / len(llr))
    return out


def test_url_scores_match_a_plain_model(spark):
    rng = random.Random(3)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randrange(2, 9)))
    rows = [(f"http://{word('abcde')}.com/{word('abc')}?é={i}", "allow") for i in range(30)]
    rows += [(f"http://{word('xyzw')}.net/es/{word('xyz')}{i}", "block") for i in range(30)]
    rows += [(f"http://{word('abxy')}.org/{word('abxy')}{i}", None) for i in range(30)]
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    want = plain_scores(rows)
    for r in urls.judge_urls(df).collect():
        assert abs(r.score - want[rows[r.page_id][0]]) <= 1  # a logarithm's last digit
        if rows[r.page_id][1]:
            assert r.verdict == rows[r.page_id][1]


def test_a_url_of_a_million_characters(spark):
    rng = random.Random(5)
    long = "http://a.com/" + "".join(rng.choice("abcdefgh/&=") for _ in range(1_000_000))
    df = spark.createDataFrame([(1, long), (2, "http://x.net/es/a"), (3, None), (4, "http://é.org/"), (5, long)], "page_id long, url string")
    out = {r.page_id: r for r in urls.judge_urls(df).collect()}
    assert len(out) == 5 and out[1].path == long[len("http://a.com"):] and out[1].score == out[5].score and out[2].verdict == "block"
