"""The three entry points end to end: prepare panel, forecast and score, holidays."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelforge.plans import pipelines as P
from panelforge.plans.specs import DEFAULT_VARIANTS, SplitSpec
from panelforge.session import scratch_path
from panelforge.sources import bindings as B
from panelforge.sources.files import read_csv, write_table

from .conftest import SF001


def test_prepare_panel_writes_splits_and_prunes(spark):
    out = scratch_path(spark, "prepare")
    windows = {"context": ("1995-01-01", "1998-12-31"), "validation": ("1999-01-01", "1999-12-31"),
               "test": ("2000-01-01", "2001-12-31")}
    tagged = P.prepare_panel(B.security_panel_raw(spark, SF001), SplitSpec(windows=windows), out_dir=out,
                             formats=("parquet",), prefix_entity=True)
    back = spark.read.parquet(f"{out}/parquet")
    assert back.count() == tagged.count()
    val = back.where(F.col("split") == "validation")
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    days = val.select(F.min("timestamp"), F.max("timestamp")).first()
    assert days[0] == dt.date(1999, 1, 1) and days[1] == dt.date(1999, 12, 31)
    n = {r["split"]: r["count"] for r in back.groupBy("split").count().collect()}
    assert n["all"] == n["context"] + n["validation"] + n["test"]


def test_forecast_and_score_pipeline(spark):
    obs = B.event_series(spark, SF001)
    from panelforge.operators.panel import densify, select_window
    dense = densify(obs, ["id"], "timestamp", ["y", "x", "z"]).checkpoint()
    ctx = select_window(dense, ("2024-01-01", "2024-01-23"))
    test = select_window(dense, ("2024-01-24", "2024-01-30"))
    specs = [s.__class__(**{**s.__dict__, "horizon": 7}) for s in DEFAULT_VARIANTS]
    combined, scores, long = P.forecast_and_score(ctx, test, specs, null_policy="skip")
    assert {r["model"] for r in scores.collect()} == {s.name for s in specs}
    assert long.count() == 5 * len(specs)
    assert combined.groupBy("model").count().where("count > 0").count() == len(specs)


def test_build_holidays_exports(spark):
    out = scratch_path(spark, "holidays")
    us, nyse = P.build_holidays("2023-01-01", "2024-12-31", out_dir=out, spark=spark)
    assert us.columns == ["timestamp", "publicHolidaysUS", "unofficialHolidaysUS"]
    assert nyse.columns == ["timestamp", "financialHolidaysNYSE"]
    back = spark.read.parquet(f"{out}/nyse_holidays.parquet")
    assert back.count() == us.count()
    csv = read_csv(spark, f"{out}/us_holidays.csv")
    assert csv.count() == us.count()


def test_csv_extra_na_tokens(spark):
    path = scratch_path(spark, "na_tokens")
    df = spark.createDataFrame([("A", "1.5"), ("NA", "NA"), ("", "2")], "ticker string, v string")
    write_table(df.coalesce(1), path, fmt="csv")
    back = read_csv(spark, path, na_tokens=("", "NA"))
    rows = sorted(back.collect(), key=lambda r: str(r["v"]))
    assert [r["ticker"] for r in rows] == ["A", None, None]
    assert sorted([r["v"] for r in rows], key=str) == ["1.5", "2", None]


def test_input_order_follows_the_file(spark):
    from panelforge.operators import panel
    from panelforge.sources.files import with_input_order
    path = scratch_path(spark, "input_order")
    rows = [(1, "2024-01-02", None, "AAA"), (1, "2024-01-02", 0.5, "BBB"), (1, "2024-01-02", 0.7, None),
            (2, "2024-01-03", 0.1, "CCC")]
    spark.createDataFrame(rows, "permco long, timestamp string, dlyret double, ticker string") \
        .coalesce(1).write.option("header", True).csv(path)
    df = with_input_order(read_csv(spark, path, schema="permco long, timestamp string, dlyret double, ticker string"))
    first = panel.first_valid_long(df, ["permco", "timestamp"], ["dlyret"], "ord")
    got = {r["permco"]: r["dlyret"] for r in first.collect()}
    assert got == {1: 0.5, 2: 0.1}
    labels = {r["permco"]: r["label"] for r in panel.last_label(df, "permco", "ticker", "ord").collect()}
    assert labels == {1: "BBB", 2: "CCC"}
