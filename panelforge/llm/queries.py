"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bagminhash, dac, decontam, hmm, knn, langid, linedup, packing, quality, runs, shards, urls
from .pairtokens import PairTokenizer
from .scratch import table
from .tokens import UnitTokenizer

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def fold_of(n: int, key: str = "doc_id") -> Column:
    """crc32 of the key's text modulo n; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_of(5) == 0)
    return langid.identify(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (quality.quality_rules(docs, keep=["doc_id"])
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.byte_shards(table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "global_start")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_of(10) == 0)
    return hmm.score_texts(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), UnitTokenizer(tokenizer_path()))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.read_tokens(dac.write_tokens(table(spark, sf_dir, "documents"), UnitTokenizer(tokenizer_path())))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (bagminhash.near_duplicates(table(spark, sf_dir, "documents"))
            .select("doc_id", "class_id", "n_copies"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_of(3) == 1)
    return knn.vote(docs, table(spark, sf_dir, "labels").filter(fold_of(3) != 1), keep=["doc_id", "held_out"])


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", runs.planted(F.col("text"), F.col("doc_id")).alias("text"))
    return runs.digest(runs.periodic_runs(texts, keep=["doc_id"]))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = PairTokenizer(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return align.align(table(spark, sf_dir, "documents"), pair, keep=["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_quality_rules, op3_sharding, op4_lm_scoring, op5_packing, op6_url_filter,
                            op7_token_file, op8_near_duplicates, op9_decontamination, op10_line_dedup, op11_quality_score,
                            op12_periodic_runs, op13_token_alignment)}
