from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from panelforge.llm import knn, queries
from panelforge.llm.bytewords import pieces
from panelforge.llm.scratch import table

SF = "/root/testdata/sf0.001"


def prose(rng, n):
    return " ".join(rng.choice(["river", "stone", "éa", "carry", "low", "seven", "blue", "Night", "field."]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    good = [(i, prose(rng, rng.randint(5, 60)), 1) for i in range(60)]
    bad = [(100 + i, " ".join(w.upper() + "!!" for w in prose(rng, 30).split()), 0) for i in range(20)]
    bad += [(130 + i, " ".join(w for w in prose(rng, 6).split() for _ in range(9)), 0) for i in range(20)]
    return good + bad


def test_counts_are_those_of_each_text_alone():
    texts = ["One two two 3", "", " \n ", "ab", "éé éé éé", "One two two 3", "two 3 two", "two 3"]
    _, _, data, offs = next(pieces(pa.array(texts)))
    together = knn.counts(data, offs)
    for i, t in enumerate(texts):
        alone = knn.counts(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        assert (together[i] == alone[0]).all()
    assert together[1].sum() == 0 and together[2].sum() == 0 and (together[0] == together[5]).all()
    folded = re.sub(r"\d", "0", texts[0]).encode()
    grams = Counter(folded[i:i + 3] for i in range(len(folded) - 2))
    words = texts[0].split()
    assert together[0].sum() == sum(grams.values()) + len(words) + 2 * (len(words) - 1)


def test_vote_equals_a_plain_loop(rows):
    rng = np.random.default_rng(0)
    c = rng.poisson(0.3, (70, knn.TERMS)).astype(np.float32)
    y = (rng.random(70) < 0.7).astype(float)
    idf = rng.random(knn.TERMS) + 0.1
    model = knn.Voters(c, y, idf)
    asked = rng.poisson(0.3, (9, knn.TERMS)).astype(np.float32)
    asked[3] = 0
    got = model.score(asked)
    for a, score in zip(asked, got, strict=True):
        x = np.log1p(a) * model.idf
        v = (x / max(np.linalg.norm(x), 1e-12)) @ model.basis
        near = sorted((-float(v @ p) / max(np.linalg.norm(v), 1e-12), i) for i, p in enumerate(model.points))[:knn.NEIGHBOURS]
        votes = [[max(-s, 0) ** knn.POWER for s, i in near if y[i] == k] for k in (0, 1)]
        bad, good = sum(votes[0]) / (1 - y.mean()), sum(votes[1]) / y.mean()
        want = good / (good + bad) if good + bad > 0 and a.any() else y.mean()
        assert math.isclose(score, want, rel_tol=1e-6)


def test_directions_span_the_leading_space():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 6)) @ rng.normal(size=(6, 300))
    b = knn.directions(x, 6).astype(float)
    assert np.allclose(x @ b @ b.T, x, atol=1e-3) and np.allclose(b.T @ b, np.eye(6), atol=1e-4)


def test_rows_of_every_kind(spark, rows):
    odd = [(500, None), (501, ""), (502, " \t\n"), (None, rows[0][1]), (0, rows[0][1]), (503, "!!! ###"), (504, "river stone " * 40_000), (505, rows[70][1])]
    docs = spark.createDataFrame([(k, t, "s") for k, t in [(k, t) for k, t, _ in rows] + odd], "doc_id long, text string, score string").repartition(4)
    labels = spark.createDataFrame([(k, y) for k, _, y in rows] + [(0, None), (None, 1), (0, 1), (999, 0)], "doc_id long, quality int")
    out = knn.vote(docs, labels)
    assert out.columns == ["doc_id", "text", "score", "predicted"]
    got = out.collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {r.doc_id: r.score for r in got}
    assert len({by[500], by[501], by[502]}) == 1 and math.isclose(by[None], by[0], rel_tol=1e-7) and math.isclose(by[505], by[rows[70][0]], rel_tol=1e-7)
    truth = {k: y for k, _, y in rows}
    assert sum((by[k] >= 0.5) == bool(y) for k, y in truth.items()) / len(truth) > 0.97 and by[504] > 0.5
    assert knn.vote(docs.limit(0), labels).collect() == []
    assert {r.score for r in knn.vote(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in knn.vote(docs, labels.filter("quality = 1")).collect()} == {1.0}
    clash = docs.withColumnRenamed("score", "h").selectExpr("*", "doc_id good", "doc_id key", "text t", "text c")
    assert {r.doc_id: round(r.score, 7) for r in knn.vote(clash, labels).collect()} == {k: round(x, 7) for k, x in by.items()}


def test_examples_are_bounded_for_a_hot_key(spark):
    docs = spark.range(3000).selectExpr("if(id < 2900, 7, id) doc_id", "concat('text number ', id) text")
    labels = spark.createDataFrame([(7, 1), (2950, 0), (2951, 0)], "doc_id long, quality int")
    c, y = knn.examples(docs, labels, "text", "quality", "doc_id", 50)
    assert len(c) == len(y) <= 200


def test_query_on_held_out_rows(spark):
    out = queries.QUERIES["op11_quality_score"](spark, "/root/testdata/sf0.01")
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) >= 0.95
