from __future__ import annotations

import datetime as dt
import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import panel
from panelforge.operators.forecast import Columns, forecast_ols, forecast_univariate, ols_params
from panelforge.plans.pipelines import prepare_panel
from panelforge.session import ensure_checkpoint_dir
from panelforge.sources import bindings as B
from panelforge.sources.files import read_csv
from panelforge.sources.registry import load

from .conftest import SF001

COLS = Columns("id", "timestamp", "y")


@pytest.mark.parametrize("scale", [1.0, 0.01, 1e-4])
def test_two_covariates_of_any_scale(spark, scale):
    rng = np.random.default_rng(1)
    rows = [(1, float(x), float(z), float(5 + 2 * x - 3 * z)) for x, z in rng.normal(0, scale, (40, 2))]
    p = ols_params(spark.createDataFrame(rows, "id long, x double, z double, y double"), "id", "y", ["x", "z"]).first()
    assert (p["_a"], p["_b0"], p["_b1"]) == pytest.approx((5, 2, -3), rel=1e-6)
    flat = [(1, float(i), 2.0 * i, 1.0) for i in range(5)]
    assert ols_params(spark.createDataFrame(flat, "id long, x double, z double, y double"), "id", "y", ["x", "z"]).first()["_b0"] is None


def test_three_covariates_of_mixed_scales(spark):
    rng = np.random.default_rng(2)
    rows = []
    for u in (1, 2):
        for r, p, c in zip(rng.normal(0, 0.01, 60), rng.normal(90, 5, 60), rng.normal(3e9, 1e8, 60), strict=True):
            rows.append((u, float(r), float(p), float(c), float(u + 4 * r + 0.5 * p + 2e-9 * c)))
    rows += [(3, 1.0, float(i), 2.0 * i, 1.0) for i in range(9)]
    df = spark.createDataFrame(rows, "id long, r double, p double, c double, y double")
    out = {r["id"]: r for r in ols_params(df, "id", "y", ["r", "p", "c"]).collect()}
    for u in (1, 2):
        assert (out[u]["_a"], out[u]["_b0"], out[u]["_b1"], out[u]["_b2"]) == pytest.approx((u, 4, 0.5, 2e-9), rel=1e-4)
    assert out[3]["_b0"] is None


def test_short_future_is_refused(spark):
    d = dt.date(2024, 1, 1)
    ctx = spark.createDataFrame([(1, d + dt.timedelta(i), float(i), float(i % 3)) for i in range(9)], "id long, timestamp date, y double, x double")
    fut = spark.createDataFrame([(1, d + dt.timedelta(9), 1.0)], "id long, timestamp date, x double")
    assert forecast_ols(ctx, fut, ["x"], COLS, horizon=1).count() == 1
    with pytest.raises(Exception, match="fewer than 3 future rows"):
        forecast_ols(ctx, fut, ["x"], COLS, horizon=3).collect()


def test_weekly_season_and_density(spark):
    d = dt.date(2024, 1, 1)
    weeks = [(1, d + dt.timedelta(7 * i), float(i % 4)) for i in range(16)]
    df = spark.createDataFrame(weeks, "id long, timestamp date, y double")
    out = forecast_univariate(df, "seasonal_naive", 4, COLS, season=4, step="week").orderBy("timestamp").collect()
    assert [r["predictions"] for r in out] == [0.0, 1.0, 2.0, 3.0]
    assert out[0]["timestamp"] == d + dt.timedelta(7 * 16)
    with pytest.raises(Exception, match="not dense"):
        forecast_univariate(df.where(F.col("timestamp") != weeks[5][1]), "seasonal_naive", 4, COLS, season=4, step="week").collect()


def test_typed_csv_with_tokens_and_gz(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write("k,v\n1,2.5\n2,NA\n3,\n")
    out = read_csv(spark, str(tmp_path / "a.csv.gz"), "k long, v double", na_tokens=("", "NA"))
    assert dict(out.dtypes) == {"k": "bigint", "v": "double"}
    assert [tuple(r) for r in out.orderBy("k").collect()] == [(1, 2.5), (2, None), (3, None)]


def test_densify_ignores_null_keys_and_takes_empty_input(spark):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(1, d, 1.0), (1, d + dt.timedelta(2), 2.0), (None, d, 3.0)], "id long, timestamp date, y double")
    assert sorted(r["id"] for r in panel.densify(df, ["id"], "timestamp", ["y"]).collect()) == [1, 1, 1]
    assert panel.densify(df.withColumn("y", F.lit(None).cast("double")), ["id"], "timestamp", ["y"]).count() == 0


def test_widen_keeps_types_and_takes_many_entities(spark):
    d = dt.date(2024, 1, 1)
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(d + dt.timedelta(i), d, big, "t", i) for i in range(2)], "e date, timestamp date, v long, ticker string, ord long")
    row = panel.widen(df, "e", "timestamp", ["v"], "ord", "ticker").first()
    assert row["2024-01-01_t_v"] == big
    many = spark.range(6000).selectExpr("id AS e", "DATE'2024-01-01' AS timestamp", "CAST(id AS double) AS v", "'t' AS ticker", "id AS ord")
    assert panel.dense_long(many, "e", "timestamp", ["v"], "ord", "ticker").count() == 6000
    some = panel.widen(many, "e", "timestamp", ["v"], "ord", "ticker", entities=[7, 5999])
    assert some.columns == ["id", "timestamp", "7_t_v", "5999_t_v"]


def test_registry_projection_keeps_headers(spark):
    out = load(spark, SF001, "orders_enriched", columns=["o_totalprice"])
    assert "o_totalprice" in out.columns and "o_custkey" not in out.columns and out.count() > 0


def test_entry_one_raises_on_a_bad_date(spark):
    raw = B.security_panel_raw(spark, SF001).limit(50)
    bad = raw.withColumn("dlycaldt", F.when(F.col("ord") == raw.agg(F.min("ord")).first()[0], "junk").otherwise(F.col("dlycaldt")))
    with pytest.raises(ValueError, match="1 of 50 rows"):
        prepare_panel(bad)


def test_checkpoint_folder_must_be_named_on_a_cluster():
    class Sc:
        master = "spark://host:7077"
        def getCheckpointDir(self): return None
        def getConf(self): return {}
    class Session:
        sparkContext = Sc()
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_wide_plan_has_no_expression_a_column(spark):
    df = spark.range(2000).selectExpr("id AS e", "DATE'2024-01-01' AS timestamp", "CAST(id AS double) AS v", "CAST(NULL AS long) AS w", "'t' AS ticker", "id AS ord")
    wide = panel.widen(df, "e", "timestamp", ["v", "w"], "ord", "ticker")
    assert wide._jdf.queryExecution().optimizedPlan().nodeName() == "MapInArrow"  # a Project holds an expression a column
    row = wide.first()
    assert len(row) == 4002 and row["1999_t_v"] == 1999.0 and row["1999_t_w"] is None and wide.schema["7_t_w"].dataType.simpleString() == "bigint"
