"""Invariants, brute-force cross-checks and plan shape (SURVEY 5 (c), (d))."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelforge.operators import panel
from panelforge.operators.forecast import (Columns, forecast_ols, forecast_univariate, ols_params,
                                           time_grid)
from panelforge.operators.index import batch_groups, ordinal_index
from panelforge.plans.queries import QUERIES
from panelforge.sources import bindings as B
from panelforge.sources.calendars import easter_sunday, holiday_calendar

from .conftest import SF001

D = dt.date


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_densify_rows_are_ids_times_days(spark):
    obs = B.event_series(spark, SF001)
    dense = panel.densify(obs, ["id"], "timestamp", ["y", "x", "z"])
    n_ids = obs.select("id").distinct().count()
    lo, hi = obs.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert dense.count() == n_ids * ((hi - lo).days + 1)
    assert dense.where(F.col("y").isNotNull()).count() == obs.count()


def test_densify_entity_bounds(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), 1.0), (1, D(2024, 1, 4), 2.0), (2, D(2024, 1, 2), 3.0)],
                               "id long, timestamp date, y double")
    dense = panel.densify(df, ["id"], "timestamp", ["y"], bounds="entity")
    assert dense.where("id = 1").count() == 4 and dense.where("id = 2").count() == 1


def test_splits_disjoint_and_cover_all(spark):
    tagged = QUERIES["panel_splits"](spark, SF001)
    parts = {s: {(r["id"], r["timestamp"]) for r in tagged.where(F.col("split") == s).collect()}
             for s in ("context", "validation", "test", "all")}
    assert not parts["context"] & parts["validation"] and not parts["validation"] & parts["test"]
    assert parts["context"] | parts["validation"] | parts["test"] == parts["all"]


def test_quantiles_monotone_and_rmse_squared_is_mse(spark):
    pred = QUERIES["fc_combined"](spark, SF001)
    bad = pred.where((F.col("q10") > F.col("q50")) | (F.col("q50") > F.col("q90"))).count()
    assert bad == 0
    for r in QUERIES["score_by_model_skip"](spark, SF001).collect():
        if r["RMSE"] is not None:
            assert r["RMSE"] ** 2 == pytest.approx(r["MSE"], rel=1e-5)


def test_melt_matches_wide_scores(spark):
    wide = {r["model"]: r.asDict() for r in QUERIES["score_by_model"](spark, SF001).collect()}
    for r in QUERIES["score_long"](spark, SF001).collect():
        assert wide[r["model"]][r["metric"]] == r["value"]


def test_ordinal_index_matches_sorted_position(spark):
    df = spark.createDataFrame([(int(k),) for k in np.random.default_rng(1).permutation(500)], "k long")
    df = df.union(df)  # duplicates collapse
    got = {r["k"]: r["idx"] for r in ordinal_index(df, "k", partitions=7).collect()}
    assert got == {k: k for k in range(500)}
    groups = {r["k"]: r["group"] for r in batch_groups(df, "k", 100).collect()}
    assert groups[0] == 0 and groups[99] == 0 and groups[100] == 1 and groups[499] == 4


def test_ols_k3_solve_matches_numpy(spark):
    rng = np.random.default_rng(7)
    rows = []
    for unit in range(3):
        x = rng.normal(size=(40, 3))
        y = 1.5 + x @ np.array([2.0, -1.0, 0.5]) * (unit + 1) + rng.normal(scale=0.1, size=40)
        rows += [(unit, float(y[i]), *map(float, x[i])) for i in range(40)]
    df = spark.createDataFrame(rows, "u long, y double, a double, b double, c double")
    got = {r["u"]: r for r in ols_params(df, "u", "y", ["a", "b", "c"]).collect()}
    pdf = pd.DataFrame(rows, columns=["u", "y", "a", "b", "c"])
    for unit, g in pdf.groupby("u"):
        X = np.column_stack([np.ones(len(g)), g[["a", "b", "c"]].to_numpy()])
        beta = np.linalg.lstsq(X, g["y"].to_numpy(), rcond=None)[0]
        r = got[unit]
        assert [r["_a"], r["_b0"], r["_b1"], r["_b2"]] == pytest.approx(list(beta), rel=1e-8, abs=1e-8)


def test_ols_k2_singular_gives_null(spark):
    ctx = spark.createDataFrame([(1, D(2024, 1, d), float(d), float(d), float(d)) for d in range(1, 6)],
                                "id long, timestamp date, y double, x double, z double")
    fut = spark.createDataFrame([(1, D(2024, 1, 6), 6.0, 6.0)], "id long, timestamp date, x double, z double")
    r = forecast_ols(ctx, fut, ["x", "z"]).first()
    assert r["predictions"] is None


def test_univariate_methods_on_a_line(spark):
    rows = [(1, D(2024, 1, d), 2.0 * d) for d in range(1, 11)]
    ctx = spark.createDataFrame(rows, "id long, timestamp date, y double")
    expect = {"naive": 20.0, "mean": 11.0, "drift": 22.0, "trend": 22.0}
    for method, first in expect.items():
        out = forecast_univariate(ctx, method, 3).orderBy("timestamp").collect()
        assert [r["timestamp"] for r in out] == [D(2024, 1, 11), D(2024, 1, 12), D(2024, 1, 13)]
        assert out[0]["predictions"] == pytest.approx(first), method


def test_seasonal_naive_repeats_last_season(spark):
    rows = [(1, D(2024, 1, 1) + dt.timedelta(days=d), float(d % 7)) for d in range(21)]
    ctx = spark.createDataFrame(rows, "id long, timestamp date, y double")
    out = forecast_univariate(ctx, "seasonal_naive", 9, season=7).orderBy("timestamp").collect()
    assert [r["predictions"] for r in out] == [0.0, 1, 2, 3, 4, 5, 6, 0, 1]
    assert all(r["q10"] == r["predictions"] for r in out)  # zero residuals


def test_time_grid_hours(spark):
    last = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 22))], "id long, _T timestamp_ntz")
    got = [r["timestamp"] for r in time_grid(last, 3, Columns(), step="hour").orderBy("timestamp").collect()]
    assert got[-1] == dt.datetime(2024, 1, 2, 1)


def test_easter_matches_dateutil(spark):
    from dateutil.easter import easter
    years = list(range(1900, 2101))
    df = spark.createDataFrame([(y,) for y in years], "y int").select("y", easter_sunday(F.col("y")).alias("e"))
    assert {r["y"]: r["e"] for r in df.collect()} == {y: easter(y) for y in years}


def test_known_holidays(spark):
    cal = {r["timestamp"]: r for r in holiday_calendar("2020-01-01", "2024-12-31", spark=spark).collect()}
    assert cal[D(2024, 11, 28)]["publicHolidaysUS"] == "Thanksgiving Day"
    assert cal[D(2024, 1, 15)]["financialHolidaysNYSE"] == "Martin Luther King Jr. Day"
    assert cal[D(2024, 3, 29)]["financialHolidaysNYSE"] == "Good Friday"
    assert cal[D(2024, 3, 29)]["publicHolidaysUS"] is None
    assert cal[D(2021, 7, 5)]["publicHolidaysUS"] == "Independence Day (observed)"
    assert cal[D(2021, 12, 31)]["publicHolidaysUS"] == "New Year's Day (observed)"
    assert cal[D(2021, 12, 31)]["financialHolidaysNYSE"] is None   # NYSE: no Friday for a Saturday New Year
    assert cal[D(2022, 6, 20)]["financialHolidaysNYSE"] == "Juneteenth National Independence Day (observed)"
    assert D(2021, 6, 18) not in cal or cal[D(2021, 6, 18)]["financialHolidaysNYSE"] is None
    assert cal[D(2020, 11, 3)]["unofficialHolidaysUS"] == "Election Day"
    assert cal[D(2024, 5, 27)]["publicHolidaysUS"] == "Memorial Day"


def test_first_valid_stays_on_hash_aggregate(spark):
    plan = _plan(QUERIES["first_valid_long"](spark, SF001))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_no_python_outside_the_model_slot(spark):
    for name in ("fc_combined", "score_by_model", "panel_densified", "holiday_flags", "macro_asof"):
        plan = _plan(QUERIES[name](spark, SF001))
        assert "Python" not in plan and "ArrowEval" not in plan, name
    assert "FlatMapCoGroupsInPandas" in _plan(QUERIES["fc_apply_model"](spark, SF001))


def test_window_free_group_numbering(spark):
    """batch_groups never plans an unpartitioned window over the keys."""
    df = spark.range(1000).withColumnRenamed("id", "k")
    plan = _plan(batch_groups(df, "k", 100))
    # keys are numbered inside their (checkpointed) range partitions; only the
    # per-partition counts (one row per partition) meet in one task.
    assert "Scan ExistingRDD" in plan and "hashpartitioning(_pid" in plan


def test_wide_panel_matches_one_plain_pass(spark):
    """Per field the earliest value of a day, per entity the latest label, from one pass in input order."""
    fields = ["dlyprc", "dlyret", "dlycap", "dlyvol", "shrout", "sprtrn"]
    value, label, valued_days = {}, {}, set()
    for r in sorted(B.security_panel_raw(spark, SF001).collect(), key=lambda r: r["ord"]):
        day = dt.date.fromisoformat(r["dlycaldt"])
        for f in fields:
            if r[f] is not None:
                value.setdefault((day, r["permco"], f), r[f])
                valued_days.add(day)
        if r["ticker"] is not None and label.get(r["permco"], (day,))[0] <= day:
            label[r["permco"]] = (day, r["ticker"].strip() or "unknown")
    wide = {r["timestamp"]: r for r in QUERIES["panel_wide"](spark, SF001).collect()}
    first, last = min(valued_days), max(valued_days)
    assert sorted(wide) == [first + dt.timedelta(n) for n in range((last - first).days + 1)]
    n_cells = 0
    for day, row in wide.items():
        for name, got in row.asDict().items():
            if name in ("id", "timestamp"):
                continue
            entity, text, field = name.split("_")
            assert text == label.get(int(entity), (None, "unknown"))[1]
            want = value.get((day, int(entity), field))
            n_cells += want is not None
            assert (got is None) == (want is None) and (want is None or got == pytest.approx(round(float(want), 6), abs=1e-6))
    assert n_cells == len(value)


def test_rank_window_is_partitioned_in_forecasts(spark):
    plan = _plan(QUERIES["fc_trend"](spark, SF001))
    assert "Window" in plan and "hashpartitioning(id" in plan


def test_split_per_key_windows(spark):
    df = spark.createDataFrame([(1, D(2024, 1, d)) for d in range(1, 11)] + [(2, D(2024, 1, d)) for d in range(1, 11)],
                               "id long, timestamp date")
    bounds = spark.createDataFrame(
        [(1, "context", D(2024, 1, 1), D(2024, 1, 5)), (1, "test", D(2024, 1, 6), D(2024, 1, 10)),
         (2, "context", D(2024, 1, 1), D(2024, 1, 8)), (2, "test", D(2024, 1, 9), D(2024, 1, 10))],
        "id long, split string, start date, end date")
    got = panel.split_per_key(df, bounds, ["id"]).groupBy("id", "split").count().collect()
    assert {(r["id"], r["split"]): r["count"] for r in got} == {
        (1, "context"): 5, (1, "test"): 5, (2, "context"): 8, (2, "test"): 2}


def test_query_panel_selects_entities_by_label(spark):
    from panelforge.plans.pipelines import long_panel, query_panel
    from panelforge.plans.specs import QuerySpec
    long_df = long_panel(B.security_panel_raw(spark, SF001))
    wide = query_panel(long_df, QuerySpec(target="AF", variables=("dlyret",)), prefix_entity=True)
    cols = [c for c in wide.columns if c not in ("id", "timestamp")]
    assert cols and all(c.endswith("_AF_dlyret") for c in cols)


def test_forecast_input_casts_id_to_text(spark):
    from panelforge.plans.pipelines import forecast_input
    df = spark.createDataFrame([(1, "2024-01-02", 3.0)], "id int, timestamp string, y double")
    out = forecast_input(df)
    assert dict(out.dtypes) == {"id": "string", "timestamp": "date", "y": "double"}


def test_macro_catalog_filters_by_frequency(spark):
    from panelforge.sources.registry import macro_series, series_catalog
    cat = series_catalog(spark, [
        {"name": "A", "id": "A1", "units": "u", "seasonal_adjustment": "n", "frequency": "Monthly", "source": "s"},
        {"name": "B", "id": "B1", "units": "u", "seasonal_adjustment": "n", "frequency": "Daily", "source": "s"}])
    obs = spark.createDataFrame([("A1", 1.0), ("B1", 2.0)], "series_id string, value double")
    assert [r["series_id"] for r in macro_series(obs, cat, "monthly").collect()] == ["A1"]


def test_asof_fill_respects_availability_lag(spark):
    obs = spark.createDataFrame([("S", D(2024, 1, 1), 1.0), ("S", D(2024, 1, 4), 2.0)],
                                "series_id string, t date, value double")
    out = panel.asof_fill(obs, "series_id", "t", "value", F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 6)),
                          lag_days=1)
    got = {r["timestamp"]: r["value"] for r in out.collect()}
    assert got[D(2024, 1, 1)] is None and got[D(2024, 1, 2)] == 1.0 and got[D(2024, 1, 5)] == 2.0


def test_approx_quantiles_close_to_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, D(2020, 1, 1) + dt.timedelta(days=d), float(rng.normal()))
            for i in range(3) for d in range(400)]
    ctx = spark.createDataFrame(rows, "id long, timestamp date, y double")
    exact = {(r["id"], r["timestamp"]): r for r in forecast_univariate(ctx, "mean", 2).collect()}
    approx = forecast_univariate(ctx, "mean", 2, quantile_method="approx").collect()
    for r in approx:
        e = exact[(r["id"], r["timestamp"])]
        assert r["predictions"] == pytest.approx(e["predictions"])
        assert abs(r["q90"] - e["q90"]) < 0.05 and abs(r["q10"] - e["q10"]) < 0.05


def test_densify_hourly_steps(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 0), 1.0), (1, dt.datetime(2024, 1, 1, 5), 2.0),
            (2, dt.datetime(2024, 1, 1, 2), 3.0)]
    df = spark.createDataFrame(rows, "id long, timestamp timestamp_ntz, y double")
    dense = panel.densify(df, ["id"], "timestamp", ["y"], step="hour")
    assert dense.count() == 2 * 6
    assert dense.where("id = 2 AND y IS NOT NULL").count() == 1


def test_hourly_trend_and_drift(spark):
    start = dt.datetime(2024, 1, 1, 20)
    rows = [(1, start + dt.timedelta(hours=h), 3.0 * h + 1) for h in range(12)]
    ctx = spark.createDataFrame(rows, "id long, timestamp timestamp_ntz, y double")
    for method in ("trend", "drift"):
        out = forecast_univariate(ctx, method, 3, step="hour").orderBy("timestamp").collect()
        assert [r["timestamp"] for r in out] == [start + dt.timedelta(hours=h) for h in (12, 13, 14)]
        assert [r["predictions"] for r in out] == pytest.approx([37.0, 40.0, 43.0]), method


def test_seasonal_naive_hourly(spark):
    start = dt.datetime(2024, 1, 1, 0)
    rows = [(1, start + dt.timedelta(hours=h), float(h % 24)) for h in range(72)]
    ctx = spark.createDataFrame(rows, "id long, timestamp timestamp_ntz, y double")
    out = forecast_univariate(ctx, "seasonal_naive", 26, season=24, step="hour").orderBy("timestamp").collect()
    assert [r["predictions"] for r in out] == [float(h % 24) for h in range(26)]


def test_registry_filters_reach_the_parquet_scan(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = _plan(QUERIES["registry_load"](spark, SF001))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    scan = next(line for line in plan.splitlines() if "orders.parquet" in line)
    pushed = scan.split("PushedFilters:")[1].split("ReadSchema:")[0]
    assert "In(o_orderpriority" in pushed and "GreaterThanOrEqual(o_orderdate" in pushed
    schema = scan.split("ReadSchema:")[1]
    assert "o_orderpriority" in schema and "o_comment" not in schema
