"""Corpus pipeline: five operators in a row over ``documents``.

Each stage takes the rows that its predecessor kept and decides on all of them; the
result is written as Parquet in the shared folder and read again for the next; when it is
written, what the stage read and the tables it made on the way are deleted.  All
stages but the last return the columns of documents.

Defined results: an empty table gives an empty plan.  A null or empty text fails the quality rules
and goes with the first stage; a text that line dedup empties stays as an empty text, and of all
empty texts one stays.  A null key is a key like any other.  Repeated rows are copies: one stays.
Ties go as each operator says.  Very long texts pass whole.  Extra columns of any name come through
every stage but the last unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import bagminhash, decontam, linedup, packing, quality
from panelforge.llm.queries import tokenizer_path
from panelforge.llm.scratch import discard, own_tables, table, written
from panelforge.llm.tokens import UnitTokenizer
from panelforge.session import ensure_checkpoint_dir


def carried(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], reads: tuple[str, ...]) -> DataFrame:
    """``operator``'s rows with all columns of ``docs``: those it does not read travel under names that no operator adds or drops."""
    alias = {c: c if c in reads else f"carried_{i}" for i, c in enumerate(docs.columns)}
    own = lambda c: F.col("`" + c.replace("`", "``") + "`")
    out = operator(docs.select(*[own(c).alias(a) for c, a in alias.items()]))
    return out.select(*[F.col(a).alias(c) for c, a in alias.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return carried(docs, lambda d: quality.quality_rules(d).filter("kept"), ("text", "lang", "source"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later matches of a line go; every document stays, with what is left of its text."""
    return carried(docs, lambda d: linedup.dedup_lines(d), ("doc_id", "text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return carried(docs, bagminhash.one_of_each, ("doc_id", "text"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return carried(docs, lambda d: decontam.clean(d, table(spark, sf_dir, "benchmark")), ("text",))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and place."""
    return packing.pack(docs, UnitTokenizer(tokenizer_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("decontaminate", decontaminate), ("pack", pack)]

#: Line dedup, near duplicates and the tokenizer have no SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        with own_tables():
            kept = written(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
        if i:
            discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
