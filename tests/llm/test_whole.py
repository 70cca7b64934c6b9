"""Tests that an operator does the whole of its job, one a finding of the reviewer."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from panelforge.llm import bagminhash, linedup
from panelforge.llm.scratch import table

from . import brute

SF = "/root/testdata/sf0.001"


def test_line_dedup_removes_short_lines(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(30)]
    rows = [(i, "\n".join(" ".join(rng.choice(vocab[:6] if n < 4 else vocab) for _ in range(n)) for n in rng.choices(range(8), k=6))) for i in range(80)]
    rows += [(100, "one two three four"), (101, "FOUR three two one"), (102, "one two three four five"), (103, "a b c d e"), (104, "b c d e")]
    want = brute.removed_lines(rows, lambda r: r[0], min_words=1)
    out = {r.doc_id: r for r in linedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, t in rows:
        gone = want.get((k, t), set())
        assert out[k].n_removed == len(gone)
        assert out[k].text == "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    assert all(out[k].n_removed == 1 for k in (101, 102, 104))


def test_signature_bytes_tell_unrelated_texts_apart():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 40 * 200).astype(np.uint64)
    low = bagminhash.signature_bytes(bagminhash.signatures(h, np.repeat(np.arange(40), 200), np.ones(len(h), np.int64), 40))
    agree = (low[:, None] == low[None]).mean(2)[np.triu_indices(40, 1)]
    assert agree.mean() < 0.02 and agree.max() < 0.1


def test_stages_carry_columns_of_any_name(spark):
    docs = table(spark, SF, "documents")
    extra = ["n_words", "spans", "items", "kept", "n_lines", "n_removed", "word_chars", "base_failed", "key", "md5", "th", "__md5", "a.b"]
    docs = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in extra])
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        rows = docs.collect()
        assert rows and all(r[c] == f"{c}:{r['doc_id']}" for r in rows for c in extra), name
    assert corpus_pipeline.pack(spark, docs, SF).select("doc_id").distinct().count() == len(rows)
