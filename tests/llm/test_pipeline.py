from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from panelforge.llm import queries
from panelforge.llm.scratch import table

from . import brute

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontaminate", "pack"]


def test_pipeline_matches_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    judged = {r.doc_id: r.kept for r in queries.QUERIES["op2_quality_rules"](spark, SF).collect()}
    after = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        if i < 4:
            assert docs.columns == columns
            docs = docs.cache()
        after.append(docs.collect())
    good = [r for r in table(spark, SF, "documents").collect() if judged[r.doc_id]]
    assert {r.doc_id for r in after[0]} == {r.doc_id for r in good}
    gone = brute.removed_lines([(r.doc_id, r.text) for r in good], lambda r: r[0])
    cut = {r.doc_id: "\n".join(x for i, x in enumerate(r.text.split("\n")) if i not in gone.get((r.doc_id, r.text), ())) for r in good}
    assert {r.doc_id: r.text for r in after[1]} == cut
    least = brute.classes(list(cut.items()))
    stay = {k for (k, _), c in least.items() if k == c}
    assert {r.doc_id for r in after[2]} == stay
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    clean = {k for k in stay if not brute.hits(cut[k], items)[1]}
    assert {r.doc_id for r in after[3]} == clean
    assert {r.doc_id for r in after[4]} == clean and max(Counter((r.doc_id, r.piece) for r in after[4]).values()) == 1


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_the_contract(spark, name):
    df = queries.QUERIES[name](spark, SF)
    n = table(spark, SF, "pages" if name.startswith("op6") else "documents").count()
    assert df.count() >= n


def test_language_id_on_held_out_rows(spark):
    out = queries.QUERIES["op1_language_id"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in out) / len(out) >= 0.95


def test_hmm_beats_the_unigram_on_held_out_rows(spark):
    r = queries.QUERIES["op4_lm_scoring"](spark, SF).filter("held_out").selectExpr("sum(base_score) b", "sum(score) s").first()
    assert r.s > r.b
