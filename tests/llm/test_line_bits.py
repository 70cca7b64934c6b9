"""Removed lines as bits of a document, and words cut where a row ends."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from panelforge.llm import bytewords, linedup
from panelforge.llm.scratch import own_tables

from . import brute


def test_removed_lines_are_told_without_a_join_of_lines(spark, capsys):
    docs = spark.createDataFrame([(1, "a b\nc d e f g\na b"), (2, "c d e f h g\nx")], "doc_id int, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with own_tables():
            found = linedup.duplicate_lines(docs)
            found.explain()
            got = {r["key"]: sorted(r["line_nos"]) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {1: [2], 2: [0]}
    plan = capsys.readouterr().out
    assert "HashAggregate" in plan and "SortMergeJoin" not in plan


def test_removed_lines_of_long_documents_match_brute_force(spark):
    r = random.Random(9)

    def text(n):
        return "\n".join(r.choice(("", " ", " ".join(f"w{r.randrange(400)}" for _ in range(r.randint(1, 7))))) for _ in range(n))

    rows = [(None, text(200)), (3, text(64)), (3, text(65)), (4, "q\n" * 193), (5, "\n" * 63 + "q" + "\n" * 64 + "q"), (6, ""), (7, None), (8, text(130))]
    rows += [rows[0], rows[3]]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    th = {x.text: x.h for x in docs.filter("text IS NOT NULL").select("text", F.xxhash64("text").alias("h")).collect()}
    want = brute.removed_lines(rows, lambda x: (x[0] is not None, x[0] or 0, th[x[1]]))
    with own_tables():
        got = {(x["key"], x["th"]): x["line_nos"] for x in linedup.duplicate_lines(docs).collect()}
    assert {k: sorted(v) for k, v in got.items()} == {(k, th[t]): sorted(v) for (k, t), v in want.items() if v}
    assert sorted(got[5, th[rows[4][1]]]) == [63, 127] and max(got[4, th[rows[3][1]]]) == 192


def test_the_line_join_is_the_same_beyond_what_is_broadcast(spark, monkeypatch):
    r = random.Random(10)
    rows = [(i, "\n".join(" ".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(4))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    want = sorted(map(tuple, linedup.dedup_lines(docs).collect()))
    monkeypatch.setattr(linedup, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, linedup.dedup_lines(docs).collect())) == want
    assert sum(x[3] for x in want)


def test_words_end_at_rows_and_breaks():
    r = random.Random(11)
    for _ in range(200):
        rows = ["".join(r.choice("ab \né") for _ in range(r.randrange(9))) for _ in range(r.randrange(1, 7))]
        for _, _, data, offs in bytewords.pieces(pa.array(rows)):
            breaks = np.array(sorted(r.sample(range(len(data) + 1), min(len(data), 2))), np.int64) if r.random() < 0.5 else None
            cuts = sorted({*offs.tolist(), *(breaks.tolist() if breaks is not None else ())})
            want = [(lo + m.start(), lo + m.end()) for lo, hi in zip(cuts, cuts[1:], strict=False)
                    for m in re.finditer(rb"[^\x20\x09-\x0D]+", data[lo:hi].tobytes())]
            starts, ends = bytewords.bounds(data, offs, bytewords.NOT_SPACE, breaks)
            assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == want
