"""Registered queries: one per operator group of SURVEY 2 / 7.3.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
given tables.  Doubles are rounded in the output (same digits as the oracle
SQL) so engines that add in a different order still compare equal.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, panel
from ..operators.asof import RELEASE_LAG, asof_join, by_frequency
from ..operators.forecast import (Columns, apply_model, forecast_ols, forecast_schema,
                                  forecast_univariate, future_frame, weekday_mean_model)
from ..operators.frame import plot_frame
from ..operators.index import ordinal_index
from ..operators.regress import forecast_ar
from ..operators.score import combine, score, score_long
from ..session import scratch_path
from ..sources import bindings as B
from ..sources.calendars import holiday_calendar
from ..sources.files import read_csv, read_table, with_input_order, write_ordered, write_table
from ..sources.registry import load, macro_series, series_catalog
from .pipelines import apply_split, long_panel, round_doubles, run_query, wide_panel
from .specs import ForecastSpec, QuerySpec, SplitSpec

COLS = Columns("id", "timestamp", "y")
B2_WINDOWS = {"context": ("2024-01-01", B.B2_CONTEXT_END), "test": (B.B2_TEST_START, B.B2_TEST_END)}


# ------------------------------------------------------------------ B1 (lineitem)


def _b1_long(spark: SparkSession, sf: str) -> DataFrame:
    return long_panel(B.security_panel_raw(spark, sf))


def q_entity_keys(spark, sf):
    return panel.entity_keys(_b1_long(spark, sf), "permco")


def q_last_label(spark, sf):
    df = _b1_long(spark, sf)
    return panel.last_label(df, "permco", "ticker", panel.time_order(df, "timestamp", "ord"))


def q_first_valid_long(spark, sf):
    df = _b1_long(spark, sf)
    out = panel.first_valid_long(df, ["permco", "timestamp"], clean.PANEL_FIELDS, "ord")
    return round_doubles(out, 6)


def q_panel_wide(spark, sf):
    return wide_panel(round_doubles(_b1_long(spark, sf), 6), prefix_entity=True)


def q_panel_dense_long(spark, sf):
    """The wide panel's cells for every entity, long."""
    dense = panel.dense_long(_b1_long(spark, sf), "permco", "timestamp", clean.PANEL_FIELDS, "ord", "ticker")
    return round_doubles(dense, 6)


def q_panel_wide_selected(spark, sf):
    """The wide panel of a caller's entity list, melted so that names and order have a fixed schema."""
    wide = wide_panel(round_doubles(_b1_long(spark, sf), 6), prefix_entity=True, entities=B.SELECTED_ENTITIES)
    values = [c for c in wide.columns if c not in ("id", "timestamp")]
    return panel.melt(wide.drop("id"), ["timestamp"], values, "column_name", "value")


def _b1_blocks(spark, sf):
    long_df = round_doubles(_b1_long(spark, sf), 6).checkpoint(eager=True)
    return panel.wide_blocks(long_df, "permco", "timestamp", clean.PANEL_FIELDS, "ord", "ticker", per_block=40, prefix_entity=True)


def q_panel_manifest(spark, sf):
    """R2: the wide panel's columns by block and position."""
    return _b1_blocks(spark, sf)[0]


def q_panel_blocks(spark, sf):
    """The wide panel's values read from its blocks under the manifest's names."""
    manifest, blocks = _b1_blocks(spark, sf)
    return panel.block_cells(blocks, manifest, "timestamp", clean.PANEL_FIELDS)


def q_dup_and_null_checks(spark, sf):
    raw = B.security_panel_raw(spark, sf)
    return clean.check_counts(raw, ["permco", "dlycaldt"], raw_time_col="dlycaldt")


def q_csv_roundtrip(spark, sf):
    """Export with untidy headers, read back, normalise, check, cast."""
    raw = B.security_panel_raw(spark, sf).drop("ord")
    messy = raw.toDF(*[f" {c.upper()} " if i % 2 else c.capitalize() for i, c in enumerate(raw.columns)])
    path = scratch_path(spark, "csv_roundtrip")
    write_table(messy, path, fmt="csv")
    back = clean.require_columns(clean.normalise_headers(read_csv(spark, path)), clean.RAW_PANEL_COLUMNS)
    typed = back.select(
        "ticker", F.col("permco").cast("bigint").alias("permco"), "dlycaldt",
        *[F.col(c).cast("double").alias(c) for c in clean.RAW_PANEL_COLUMNS[3:]])
    return round_doubles(typed, 6)


# ------------------------------------------------------------------- B2 (events)


def _b2_dense(spark, sf, materialize: bool = True):
    """Dense daily event panel.  Every forecast branch (context, test, future,
    residuals) reads it, so it is computed once and checkpointed to the shared
    folder instead of re-scanning the raw events per branch."""
    obs = B.event_series(spark, sf).checkpoint(eager=True)
    dense = panel.densify(obs, ["id"], "timestamp", ["y", "x", "z"])
    return dense.checkpoint(eager=True) if materialize else dense


def _b2_parts(spark, sf):
    dense = _b2_dense(spark, sf)
    ctx = panel.select_window(dense, B2_WINDOWS["context"])
    test = panel.select_window(dense, B2_WINDOWS["test"])
    return ctx, test


def q_panel_densified(spark, sf):
    return _b2_dense(spark, sf, materialize=False)


def _fc_seasonal(ctx):
    return forecast_univariate(ctx, "seasonal_naive", B.B2_HORIZON, COLS, season=B.B2_SEASON)


def _fc_ols(ctx, test, batch_size=None):
    fut = future_frame(test, B.B2_HORIZON, COLS)
    return forecast_ols(ctx, fut, ["x", "z"], COLS, batch_size=batch_size)


def q_fc_seasonal_naive(spark, sf):
    ctx, _ = _b2_parts(spark, sf)
    return round_doubles(_fc_seasonal(ctx), 4)


def q_fc_covariate_ols(spark, sf):
    ctx, test = _b2_parts(spark, sf)
    return round_doubles(_fc_ols(ctx, test), 4)


def q_fc_pooled_ols(spark, sf):
    ctx, test = _b2_parts(spark, sf)
    return round_doubles(_fc_ols(ctx, test, batch_size=100), 4)


def q_fc_past_covariates(spark, sf):
    """Z is known in the context only, x ahead too; one fit per series and step."""
    ctx, test = _b2_parts(spark, sf)
    fut = future_frame(test, B.B2_HORIZON, COLS).drop("z")
    return round_doubles(forecast_ols(ctx, fut, ["x", "z"], COLS, horizon=B.B2_HORIZON), 4)


def q_fc_pooled_ar(spark, sf):
    """Bare series share an autoregression per batch of 100."""
    ctx, _ = _b2_parts(spark, sf)
    return round_doubles(forecast_ar(ctx, B.B2_HORIZON, COLS, lags=(1, B.B2_SEASON), batch_size=100), 4)


#: One column of the security panel, all other columns as known-future covariates.
PANEL_QUERY = QuerySpec(target="1", target_variable="dlyvol", dataset="security_lines")
PANEL_SPLIT = SplitSpec(windows=dict(B.B3_WINDOWS))
PANEL_VARIANTS = (ForecastSpec("no_covariates", "mean", horizon=120), ForecastSpec("with_covariates", "ridge", horizon=120, screen=12))
#: The same variants with every covariate in the fit.
WHOLE_VARIANTS = tuple(replace(v, screen=None) for v in PANEL_VARIANTS)


def _panel_query(spark, sf, variants=PANEL_VARIANTS):
    return run_query(long_panel(B.PANELS[PANEL_QUERY.dataset](spark, sf)), PANEL_QUERY, PANEL_SPLIT, variants, COLS)


def q_fc_panel_covariates(spark, sf):
    return round_doubles(_panel_query(spark, sf)[0], 4)


def q_score_panel_covariates(spark, sf):
    pred, truth = _panel_query(spark, sf, WHOLE_VARIANTS)
    return round_doubles(score(pred, truth, COLS, "skip"), 6)


def _combined(spark, sf):
    ctx, test = _b2_parts(spark, sf)
    comb = combine({"no_covariates": _fc_seasonal(ctx),
                    "with_covariates": _fc_ols(ctx, test),
                    "with_covariates_cross_learning": _fc_ols(ctx, test, batch_size=100)})
    return comb, ctx, test


def q_fc_combined(spark, sf):
    return round_doubles(_combined(spark, sf)[0], 4)


def q_score_by_model(spark, sf):
    comb, _, test = _combined(spark, sf)
    return round_doubles(score(comb, test, COLS, "propagate"), 6)


def q_score_by_model_skip(spark, sf):
    comb, _, test = _combined(spark, sf)
    return round_doubles(score(comb, test, COLS, "skip"), 6)


def q_score_long(spark, sf):
    comb, _, test = _combined(spark, sf)
    return round_doubles(score_long(score(comb, test, COLS, "propagate")), 6)


def _plot(spark, sf, ids=None):
    comb, ctx, test = _combined(spark, sf)
    return round_doubles(plot_frame(ctx, comb, test, COLS, history_length=14, by="model", ids=ids), 4)


def q_plot_frame(spark, sf):
    return _plot(spark, sf)


def q_plot_frame_one(spark, sf):
    """the frame of one series, as a chart asks for it."""
    return _plot(spark, sf, ids=B.PLOT_IDS)


def q_fc_apply_model(spark, sf):
    ctx, test = _b2_parts(spark, sf)
    fut = future_frame(test, B.B2_HORIZON, COLS)
    out = apply_model(ctx, weekday_mean_model(B.B2_HORIZON, cols=COLS), forecast_schema(), fut, COLS,
                      batch_size=100)
    out = out.select(*[F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c)
                       if c in ("predictions", "q10", "q50", "q90") else F.col(c) for c in out.columns])
    return round_doubles(out, 6)


def q_fc_apply_model_rows(spark, sf):
    """The model slot with batches cut at a row budget."""
    ctx, test = _b2_parts(spark, sf)
    out = apply_model(ctx, weekday_mean_model(B.B2_HORIZON, cols=COLS), forecast_schema(), future_frame(test, B.B2_HORIZON, COLS), COLS,
                      batch_rows=1000)
    return round_doubles(out.select(*[F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) if c in ("predictions", "q10", "q50", "q90")
                                      else F.col(c) for c in out.columns]), 6)


def q_fc_hourly(spark, sf):
    """Hourly series, a season of one day, 24 hours ahead."""
    obs = B.hourly_series(spark, sf).checkpoint(eager=True)
    dense = panel.densify(obs, ["id"], "timestamp", ["y"], step="hour").checkpoint(eager=True)
    ctx = dense.where(F.col("timestamp") < F.lit(B.B2_TEST_START).cast("timestamp_ntz"))
    return round_doubles(forecast_univariate(ctx, "seasonal_naive", 24, COLS, season=24, step="hour"), 4)


# ---------------------------------------------------------- B3 (orders x customer)


def _b3_dense(spark, sf, materialize: bool = False):
    # The observed daily series is materialized once: densify reads it twice.
    obs = B.nation_series(spark, sf).checkpoint(eager=True)
    dense = panel.densify(obs, ["id"], "timestamp", ["y"])
    return dense.checkpoint(eager=True) if materialize else dense


def q_panel_splits(spark, sf):
    return panel.split_windows(_b3_dense(spark, sf), B.B3_WINDOWS, "timestamp")


def q_panel_splits_per_key(spark, sf):
    """T10 ``partition_by``: windows per series from its own valued span
    (first 70 % context, next 15 % validation, rest test), applied by an
    equi-join on the key plus a range condition."""
    dense = _b3_dense(spark, sf)
    return apply_split(dense, SplitSpec(partition_by=("id",)), value="y")


def q_split_counts(spark, sf):
    tagged = q_panel_splits(spark, sf)
    return tagged.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"),
        F.min("timestamp").alias("min_ts"), F.max("timestamp").alias("max_ts"),
        F.count("y").alias("n_valued"), F.round(F.sum("y"), 2).alias("sum_y"))


def q_profile(spark, sf):
    return panel.profile(_b3_dense(spark, sf), "id", "timestamp", "y")


def q_ordered_export(spark, sf):
    """The panel written in time order as CSV, read back with each row's place in the files."""
    path = scratch_path(spark, "ordered_export")
    write_ordered(_b3_dense(spark, sf, materialize=True), path, ["timestamp", "id"], fmt="csv")
    back = with_input_order(read_csv(spark, path, schema="id long, timestamp date, y double")).checkpoint(eager=True)
    place = ordinal_index(back, "ord", "position")
    return back.join(place, "ord").select("id", "timestamp", "y", "position")


def _b3_fc(spark, sf, method):
    ctx = panel.select_window(_b3_dense(spark, sf, materialize=True), B.B3_WINDOWS["context"])
    return round_doubles(forecast_univariate(ctx, method, B.B3_HORIZON, COLS), 4)


def q_fc_naive(spark, sf):
    return _b3_fc(spark, sf, "naive")


def q_fc_mean(spark, sf):
    return _b3_fc(spark, sf, "mean")


def q_fc_drift(spark, sf):
    return _b3_fc(spark, sf, "drift")


def q_fc_trend(spark, sf):
    return _b3_fc(spark, sf, "trend")


def q_fc_weekly(spark, sf):
    """Weekly totals from Monday on, 13 weeks ahead."""
    weekly = (B.nation_series(spark, sf).groupBy("id", F.trunc("timestamp", "week").alias("timestamp"))
              .agg(F.round(F.sum("y"), 2).alias("y")).checkpoint(eager=True))
    dense = panel.densify(weekly, ["id"], "timestamp", ["y"], step="week").checkpoint(eager=True)
    ctx = panel.select_window(dense, B.B3_WINDOWS["context"])
    return round_doubles(forecast_univariate(ctx, "drift", 13, COLS, step="week"), 4)


def q_fc_holiday_covariates(spark, sf):
    """Holiday flags as known-future covariates of every nation's series."""
    cal = _order_calendar(spark, sf)
    flag = lambda c: F.col(c).isNotNull().cast("double")
    dense = (_b3_dense(spark, sf).join(F.broadcast(cal), "timestamp", "left")
             .select("id", "timestamp", "y", flag("publicHolidaysUS").alias("us"), flag("financialHolidaysNYSE").alias("nyse"))
             .checkpoint(eager=True))
    ctx = panel.select_window(dense, B.B3_WINDOWS["context"])
    fut = future_frame(panel.select_window(dense, B.B3_WINDOWS["validation"]), B.B3_HORIZON, COLS)
    return round_doubles(forecast_ols(ctx, fut, ["us", "nyse"], COLS, horizon=B.B3_HORIZON), 4)


def q_holiday_closures(spark, sf):
    """H5: the calendar with a user's own closures, here the days on which a nation of the first region took no order."""
    span = B.order_span(spark, sf)
    lo, hi = span.select("start").scalar(), span.select("end").scalar()
    nations = read_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"]).where(F.col("n_regionkey") == 0)
    quiet = _b3_dense(spark, sf).where(F.col("y").isNull()).join(nations, F.col("id") == F.col("n_nationkey"))
    closures = quiet.select(F.lit("financialHolidaysNYSE").alias("cal"), F.col("timestamp").alias("date"),
                            F.concat(F.lit("No orders: "), "n_name").alias("name"), F.lit("orders table").alias("source"))
    return holiday_calendar(lo, hi, spark=spark, closures=closures)


def _order_calendar(spark, sf):
    span = B.order_span(spark, sf)
    return holiday_calendar(span.select("start").scalar(), span.select("end").scalar(), spark=spark)


def q_holiday_calendar(spark, sf):
    return _order_calendar(spark, sf)


def q_holiday_us(spark, sf):
    return _order_calendar(spark, sf).select("timestamp", "publicHolidaysUS", "unofficialHolidaysUS")


def q_holiday_nyse(spark, sf):
    return _order_calendar(spark, sf).select("timestamp", "financialHolidaysNYSE")


def q_holiday_flags(spark, sf):
    """Holiday flags on the daily nation panel (calendar bounded by the span: broadcast)."""
    cal = _order_calendar(spark, sf)
    dense = _b3_dense(spark, sf)
    return (dense.join(F.broadcast(cal), "timestamp", "left")
            .select("id", "timestamp", "y",
                    F.col("publicHolidaysUS").isNotNull().alias("is_us_public"),
                    F.col("financialHolidaysNYSE").isNotNull().alias("is_nyse_closed"),
                    F.col("publicHolidaysUS").alias("holiday")))


def q_macro_asof(spark, sf):
    """Monthly order totals, usable from the next month on, carried onto the daily panel."""
    orders = read_table(spark, sf, "orders", ["o_orderdate", "o_totalprice"])
    monthly = (orders.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("month"))
               .agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
               .select(F.lit("ORDTOT").alias("series_id"),
                       F.add_months("month", 1).alias("available"), "value"))
    catalog = series_catalog(spark, [{
        "name": "Total order value", "id": "ORDTOT", "units": "Currency",
        "seasonal_adjustment": "Not Seasonally Adjusted", "frequency": "Monthly",
        "source": "orders table"}])
    obs = macro_series(monthly, catalog, "monthly").select("series_id", "available", "value")
    dense = _b3_dense(spark, sf, materialize=True).withColumn("series_id", F.lit("ORDTOT"))
    joined = asof_join(dense, obs, ["series_id"], "timestamp", "available", "value", out="macro_value")
    return joined.select("id", "timestamp", "y", "macro_value")


def q_macro_mixed(spark, sf):
    """Weekly, monthly and quarterly series of every nation on its daily panel, each from its release on."""
    obs = (B.nation_series(spark, sf).select("id", F.col("y").alias("v"), by_frequency(F.col("timestamp")).alias("p"))
           .select("id", "v", "p.*").groupBy("id", "frequency", "period_end", "available").agg(F.round(F.sum("v"), 2).alias("value")))
    left = _b3_dense(spark, sf, materialize=True).select("*", F.explode(F.array(*map(F.lit, RELEASE_LAG))).alias("frequency"))
    return asof_join(left, obs, ["id", "frequency"], "timestamp", "available", "value", order="period_end")


def q_registry_load(spark, sf):
    return load(spark, sf, "orders_enriched")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "entity_keys": q_entity_keys,
    "last_label": q_last_label,
    "first_valid_long": q_first_valid_long,
    "panel_wide": q_panel_wide,
    "panel_dense_long": q_panel_dense_long,
    "panel_wide_selected": q_panel_wide_selected,
    "panel_manifest": q_panel_manifest,
    "panel_blocks": q_panel_blocks,
    "dup_and_null_checks": q_dup_and_null_checks,
    "csv_roundtrip": q_csv_roundtrip,
    "panel_densified": q_panel_densified,
    "panel_splits": q_panel_splits,
    "panel_splits_per_key": q_panel_splits_per_key,
    "split_counts": q_split_counts,
    "ordered_export": q_ordered_export,
    "profile": q_profile,
    "fc_naive": q_fc_naive,
    "fc_mean": q_fc_mean,
    "fc_drift": q_fc_drift,
    "fc_trend": q_fc_trend,
    "fc_seasonal_naive": q_fc_seasonal_naive,
    "fc_covariate_ols": q_fc_covariate_ols,
    "fc_pooled_ols": q_fc_pooled_ols,
    "fc_past_covariates": q_fc_past_covariates,
    "fc_pooled_ar": q_fc_pooled_ar,
    "fc_panel_covariates": q_fc_panel_covariates,
    "score_panel_covariates": q_score_panel_covariates,
    "fc_combined": q_fc_combined,
    "fc_apply_model": q_fc_apply_model,
    "score_by_model": q_score_by_model,
    "score_by_model_skip": q_score_by_model_skip,
    "score_long": q_score_long,
    "plot_frame": q_plot_frame,
    "plot_frame_one": q_plot_frame_one,
    "fc_apply_model_rows": q_fc_apply_model_rows,
    "fc_hourly": q_fc_hourly,
    "fc_weekly": q_fc_weekly,
    "fc_holiday_covariates": q_fc_holiday_covariates,
    "holiday_closures": q_holiday_closures,
    "holiday_calendar": q_holiday_calendar,
    "holiday_us": q_holiday_us,
    "holiday_nyse": q_holiday_nyse,
    "holiday_flags": q_holiday_flags,
    "macro_asof": q_macro_asof,
    "macro_mixed": q_macro_mixed,
    "registry_load": q_registry_load,
}
