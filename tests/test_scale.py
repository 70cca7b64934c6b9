from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelforge.operators import panel, regress
from panelforge.plans.pipelines import query_cells
from panelforge.plans.specs import QuerySpec


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bounds,step", [("global", 1), ("entity", 1), ("global", 7), ("entity", 7)])
def test_densify_fills_in_place(spark, bounds, step):
    """Repeated rows, null times, rows without values outside the span and off the grid, keys without a valued row."""
    rng = random.Random(step)
    rows = [(rng.randrange(6), rng.choice([None, "a"]), day(7 + rng.randrange(40)) if rng.random() < 0.9 else None, rng.random(), i) for i in range(60)]
    rows += [(1, "a", day(0), None, 100), (1, "a", day(70), None, 101), (9, "a", day(20), None, 102), (8, "a", None, 5.0, 103), (8, "a", None, 5.0, 104)]
    df = spark.createDataFrame(rows, "k long, j string, timestamp date, v double, n long")
    out = panel.densify(df, ["k", "j"], "timestamp", ["v"], bounds=bounds, step="day" if step == 1 else "week")
    assert out.columns == ["k", "j", "timestamp", "v", "n"] and "Join" not in plan(out)
    named = [r for r in rows if r[1] is not None]
    valued = [(r[0], r[2]) for r in named if r[2] is not None and r[3] is not None]
    want = []
    for k in {r[0] for r in named}:
        own = [d for e, d in valued if bounds == "global" or e == k]
        d = min(own, default=day(1))
        while own and d <= max(own):
            want += [(k, "a", d, r[3], r[4]) for r in named if r[0] == k and r[2] == d] or [(k, "a", d, None, None)]
            d += dt.timedelta(step)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_dense_panel_joins_and_sorts_no_calendar_rows(spark):
    rows = [(e, f"T{e}", day(7 * i + e), float(i) if i != 3 else None, i) for e in range(4) for i in range(5)] + [(9, None, day(400), None, 0)]
    df = spark.createDataFrame(rows, "e long, label string, t date, v double, ord long")
    out = panel.dense_long(df, "e", "t", ["v"], "ord", "label")
    text = plan(out)
    top = text[:text.index("Generate")]  # the calendar's rows arise here; what is printed above runs on them
    assert not any(x in top for x in ("Join", "Sort", "Exchange"))
    seen = {(e, t): v for e, _, t, v, _ in rows}
    got = {(r.e, r.t): (r.label, r.v) for r in out.collect()}
    days = [day(n) for n in range(32)]
    assert got == {(e, t): (f"T{e}" if e < 9 else "unknown", seen.get((e, t))) for e in (0, 1, 2, 3, 9) for t in days}


def test_blocks_deal_out_observed_cells_only(spark):
    """Blocks equal a plain loop, also where an entity, a day or a block's end has no value; no grid row is joined or sorted."""
    rows = [(e, f"T{e % 3}", day(11 * i + e), float(i) if i else None, float(e), 10 * e + i) for e in range(7) for i in range(3)]
    rows += [(20, "Z", day(500), None, None, 0)]
    df = spark.createDataFrame(rows, "e long, label string, t date, p double, v double, ord long")
    manifest, blocks = panel.wide_blocks(df, "e", "t", ["p", "v"], "ord", "label", per_block=3, prefix_entity=True)
    seen = {(e, t): (p, v) for e, _, t, p, v, _ in rows}
    entities = [*range(7), 20]
    got = {(r.block, r.t): [tuple(c) for c in r.cells] for r in blocks.collect()}
    days = [day(n) for n in range(29)]
    assert got == {(b, t): [seen.get((e, t), (None, None)) for e in entities[3 * b: 3 * b + 3]] for b in range(3) for t in days}
    text = plan(blocks)
    assert not any(x in text[:text.index("Generate")] for x in ("Join", "Sort", "Exchange"))
    cells = panel.block_cells(blocks, manifest.where("field = 'v'"), "t", ["p", "v"]).collect()
    assert {(r.column_name, r.t, r.value) for r in cells} == {(f"{e}_{x}_v", t, v) for e, x, t, _, v, _ in rows if v is not None}


def test_wide_panel_moves_observed_cells_only(spark, monkeypatch):
    """The wide frame equals a plain loop; before the wide step a day holds its observed cells, in no more tasks than run at once."""
    rows = [(e, f"T{e}", day(11 * i + e), float(i) if i else None, f"n{e}", 10 * e + i) for e in range(7) for i in range(3)]
    rows += [(20, "Z", day(500), None, None, 0), (None, "N", day(1), 1.0, "x", 1), (3, "T3", None, 1.0, "x", 2), (5, "T5", day(9), None, None, 3)]
    df = spark.createDataFrame(rows, "e long, label string, t date, p double, s string, ord long").repartition(40)
    given, spread = [], panel._spread
    monkeypatch.setattr(panel, "_spread", lambda cells, names, kinds: given.append(cells) or spread(cells, names, kinds))
    monkeypatch.setattr(panel, "BATCH_CELLS", 48)  # three days
    out = panel.widen(df, "e", "t", ["p", "s"], "ord", "label")
    entities = [(e, f"T{e}") for e in range(7)] + [(20, "Z")]
    assert out.columns == ["id", "t", *[f"{x}_{f}" for _, x in entities for f in "ps"]]
    assert dict(out.dtypes)["T1_p"] == "double" and dict(out.dtypes)["T1_s"] == "string"
    seen = {(e, t): (p, s) for e, _, t, p, s, _ in rows if e is not None and t is not None}
    days = [day(n) for n in range(29)]
    want = {t: [v for e, _ in entities for v in seen.get((e, t), (None, None))] for t in days}
    assert {r.t: list(r)[2:] for r in out.collect()} == want and out.count() == 29
    held = {r.t: len(r._a) for r in given[0].collect()}
    assert held == {t: sum(v != (None, None) for (_, d), v in seen.items() if d == t) for t in days}
    assert given[0].rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def test_query_cells_keep_an_entity_together_and_unexploded(spark):
    rows = [(1, e, f"T{e}", day(i), float(i) if i % 3 else None, float(e), 100 * e + i) for e in range(9) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, permco long, ticker string, timestamp date, p double, v double, ord long")
    cells, target = query_cells(df, QuerySpec(target="T4", target_variable="v"), ["p", "v"], sid="s")
    text = plan(cells)
    assert "Generate" in text and "Scan ExistingRDD" in text and "Exchange" not in text  # written before the cells arise
    assert target == "4_T4_v" and {r[0] for r in cells.select("sid").distinct().collect()} == {"s"}
    want = {(f"{e}_T{e}_{f}", t, x) for _, e, _, t, p, v, _ in rows for f, x in (("p", p), ("v", v)) if x is not None}
    got = cells.withColumn("part", F.spark_partition_id()).collect()
    assert {(r["column"], r.timestamp, r.value) for r in got} == want and len(got) == len(want)
    assert len({(r["column"].split("_")[0], r.part) for r in got}) == 9


def test_ridge_sends_small_windows_to_the_cells(spark, monkeypatch):
    rng = random.Random(5)
    y = [(s, day(t), rng.random()) for s in "ab" for t in range(30)]
    cells = spark.createDataFrame([(s, day(t), f"c{j}", rng.random()) for s in "ab" for t in range(30) for j in range(9) if rng.random() < 0.8],
                                  "id string, timestamp date, column string, value double")
    frame = spark.createDataFrame(y, "id string, timestamp date, y double")
    ctx, fut = frame.where(F.col("timestamp") < day(25)), frame.where(F.col("timestamp") >= day(25)).drop("y")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {}
        for n in (regress.BROADCAST_ROWS, 0):
            monkeypatch.setattr(regress, "BROADCAST_ROWS", n)
            out = regress.forecast_ridge(ctx, fut, screen=4, cells=cells, horizon=5)
            assert ("BroadcastHashJoin" in plan(out)) == (n > 0)
            got[n] = sorted((r.id, r.timestamp, round(r.predictions, 9), round(r.q10, 9)) for r in out.collect())
        assert len(got[0]) == 10 and len(set(map(str, got.values()))) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
