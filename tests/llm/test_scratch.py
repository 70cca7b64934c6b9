"""What the operators leave behind in the shared folder."""

from __future__ import annotations

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelforge.llm import bagminhash, linedup
from panelforge.llm.scratch import own_tables, small_batches, written
from panelforge.session import scratch_path


def held(spark) -> set[str]:
    base = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    return set(os.listdir(base)) if os.path.isdir(base) else set()


def test_own_tables_go_after_a_failure_and_kept_ones_stay(spark):
    before = held(spark)
    with pytest.raises(ValueError), own_tables():
        written(spark.range(3), "gone")
        stays = written(spark.range(4), "stays", keep=True)
        raise ValueError
    assert [n.split("-")[0] for n in held(spark) - before] == ["stays"] and stays.count() == 4
    outside = written(spark.range(2), "outside")
    assert outside.count() == 2


def test_operators_leave_only_what_their_results_read(spark):
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.expr(
        "concat_ws(' ', transform(sequence(1, 30), i -> concat('w', i + cast(id / 6 as int) * 100 + if(i = id % 6, 50, 0))))").alias("text"))
    before = held(spark)
    lines, classes = linedup.dedup_lines(docs), bagminhash.near_duplicates(docs)
    assert {n.rsplit("-", 1)[0] for n in held(spark) - before} == {"line-cuts", "bag-bands", "bag-classes"}
    assert lines.count() == 60 and classes.count() == 60


def test_kept_tables_go_with_the_block_around(spark):
    before = held(spark)
    with own_tables():
        with own_tables():
            written(spark.range(3), "inner")
            stays = written(spark.range(4), "stays", keep=True)
        assert {n.split("-")[0] for n in held(spark) - before} == {"stays"} and stays.count() == 4
    assert held(spark) == before


def test_the_pipeline_leaves_only_what_its_last_stage_reads(spark, tmp_path, monkeypatch):
    def stage(spark, docs, sf_dir):
        with own_tables():
            kept = written(docs.select(F.col("doc_id") + 1), "kept", keep=True)
        return kept.toDF("doc_id")

    spark.range(5).toDF("doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("two", stage), ("three", stage), ("last", lambda spark, docs, sf_dir: docs)])
    before = held(spark)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {n.rsplit("-", 1)[0] for n in held(spark) - before} == {"pipeline-three"}
    assert sorted(r.doc_id for r in out.collect()) == [3, 4, 5, 6, 7]
    assert spark.read.parquet(f"{tmp_path}/documents.parquet").count() == 5


def test_small_batches_bound_what_python_gets_and_the_setting_comes_back(spark):
    def sizes(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches)

    def most():
        return spark.range(2000, numPartitions=1).select(F.repeat(F.lit("word "), 400).alias("text")).mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]

    before = most()
    with small_batches(spark, "256k"):
        assert most() < 1 << 19 < before
    assert most() == before
