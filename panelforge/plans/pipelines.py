"""End-to-end pipelines: the reference's three entry points as lazy Spark plans.

prepare_panel       raw long panel -> validated long frame -> wide dense panel -> splits
forecast_and_score  context + test -> variants -> union -> truth join -> metrics
build_holidays      day span -> US / NYSE calendars
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean, panel
from ..operators.forecast import Columns, forecast_ols, forecast_univariate, future_frame
from ..operators.regress import forecast_ar, forecast_direct, forecast_ridge
from ..operators.score import combine, score, score_long
from ..sources.calendars import holiday_calendar
from ..functions.exprs import stable_round
from ..session import ensure_checkpoint_dir
from ..sources.files import write_ordered
from .specs import DEFAULT_VARIANTS, ForecastSpec, QuerySpec, SplitSpec


def long_panel(raw: DataFrame, order_col: str = "ord", on_error: str = "null") -> DataFrame:
    """Normalise headers, require and project columns, parse dates, drop null keys."""
    df = clean.normalise_headers(raw)
    if order_col not in df.columns:
        raise KeyError(f"no input-order column {order_col!r}: first-valid and last-label need one "
                       "(use sources.files.with_input_order on the file scan, or a business key)")
    df = clean.to_long_panel(df, extra=[order_col])
    df = clean.parse_time(df, "timestamp", on_error=on_error)
    return clean.drop_null_keys(df, ["permco", "timestamp"])


def wide_panel(long_df: DataFrame, fields: Sequence[str] = clean.PANEL_FIELDS, order_col: str = "ord",
               prefix_entity: bool | None = None, entities: Sequence | None = None) -> DataFrame:
    """First-valid pivot, entity-major columns, dense daily calendar."""
    return panel.widen(long_df, "permco", "timestamp", list(fields), order=order_col, label="ticker",
                       prefix_entity=prefix_entity, entities=entities)


def forecast_input(df: DataFrame, cols: Columns = Columns(), covariates: Sequence[str] = (),
                   id_as_string: bool = True) -> DataFrame:
    """P7/P9/P11 (M6): ``id`` as text, time parsed, target plus chosen covariates."""
    idc = F.col(cols.id).cast("string") if id_as_string else F.col(cols.id)
    t = F.col(cols.time)
    if isinstance(df.schema[cols.time].dataType, T.StringType):
        t = t.try_cast("date")
    return df.select(idc.alias(cols.id), t.alias(cols.time), cols.target, *covariates)


def query_panel(long_df: DataFrame, spec: QuerySpec, fields: Sequence[str] = clean.PANEL_FIELDS,
                order_col: str = "ord", prefix_entity: bool | None = None) -> DataFrame:
    """Wide panel of the spec's target and covariate tickers only.

    Entities are selected by their label (last valid ticker), so the IN-list
    filter runs on the long rows before the pivot.
    """
    wanted = [spec.target, *spec.covariates]
    labels = panel.last_label(long_df, "permco", "ticker", panel.time_order(long_df, "timestamp", order_col))
    keep = labels.where(F.col("label").isin(wanted)).select("permco")
    # No broadcast hint: the number of matching entities is not bounded here;
    # AQE broadcasts it after measuring when it is small.
    chosen = long_df.join(keep, "permco", "left_semi")
    return wide_panel(chosen, fields=[f for f in fields if not spec.variables or f in spec.variables],
                      order_col=order_col, prefix_entity=prefix_entity)


def prepare_panel(raw: DataFrame, split: SplitSpec = SplitSpec(), out_dir: str | None = None,
                  formats: Sequence[str] = ("parquet", "csv"), prefix_entity: bool | None = None,
                  order_col: str = "ord", validate: bool = True) -> DataFrame:
    """Entry 1: returns the tagged wide panel; writes every split in one job per format.

    Unreadable dates raise with their count before anything is built;
    ``validate=False`` drops such rows instead.
    """
    if validate:
        named = clean.require_columns(clean.normalise_headers(raw), clean.RAW_PANEL_COLUMNS)
        clean.validate_panel(named, ["permco", "dlycaldt"], "dlycaldt", raw_time_col="dlycaldt")
    wide = wide_panel(long_panel(raw, order_col), order_col=order_col, prefix_entity=prefix_entity)
    tagged = apply_split(wide, split)
    if out_dir:
        for fmt in formats:
            write_ordered(tagged, f"{out_dir}/{fmt}", ["timestamp"], fmt=fmt, partition_by=["split"])
    return tagged


def apply_split(df: DataFrame, spec: SplitSpec, time: str = "timestamp", value: str | None = None) -> DataFrame:
    """Rows tagged by a split spec: shared windows, or each key's own where the spec partitions.

    A key's span runs over the rows that hold ``value`` (all without it); windows follow each other day by day.
    """
    if not spec.partition_by:
        return panel.split_windows(df, spec.windows, time, spec.all_name)
    keys = list(spec.partition_by)
    valued = df if value is None else df.where(F.col(value).isNotNull())
    span = valued.groupBy(*keys).agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    start, wins = F.col("lo"), []
    for name, share in spec.shares:
        end = F.date_add("lo", F.floor(F.datediff("hi", "lo") * share).cast("int"))
        wins.append(F.struct(F.lit(name).alias("split"), start.alias("start"), end.alias("end")))
        start = F.date_add(end, 1)
    bounds = span.select(*keys, F.explode(F.array(*wins)).alias("w")).select(*keys, "w.*")
    return panel.split_per_key(df, bounds, keys, time)


def query_cells(long_df: DataFrame, spec: QuerySpec, fields: Sequence[str] = clean.PANEL_FIELDS,
                order_col: str = "ord", entity: str = "permco", time: str = "timestamp", **columns: object) -> tuple[DataFrame, str]:
    """P16/R1 in long form: ``timestamp, column, value`` of the spec's panel, and the target's column name.

    First valid values per entity and day under the names of the wide panel, ``<entity>_<label>_<field>``.
    The spec's entities (by key or label; all without covariates) and variables are chosen on the long
    rows.  Only the target's own name comes to the driver.

    One row per entity and day is written to the shared folder, an entity's rows together, so that sums per
    column combine where they are read; names and cells arise at every read.  ``columns`` are constants to add.
    """
    ensure_checkpoint_dir(long_df.sparkSession)
    labels = panel.last_label(long_df, entity, "ticker", panel.time_order(long_df, time, order_col)).checkpoint(eager=True)
    key = F.col(entity).cast("string")
    names = lambda wanted: key.isin(list(wanted)) | F.col("label").isin(list(wanted))
    target = labels.where(names([spec.target])).select(entity, "label").limit(2).collect()
    if len(target) != 1:
        raise ValueError(f"target {spec.target!r} names {'no entity' if not target else 'several entities'}")
    target_column = f"{target[0][0]}_{target[0][1]}_{spec.target_variable}"
    if spec.covariates:
        labels = labels.where(names([spec.target, *spec.covariates]))
    firsts = panel.first_valid_long(long_df.where(F.col(time).isNotNull()), [entity, time], fields, order_col)
    chosen = [f for f in fields if not spec.variables or f in spec.variables or f == spec.target_variable]
    values = F.map_from_arrays(F.array(*[F.lit(f) for f in chosen]), F.array(*[F.col(f).cast("double") for f in chosen]))
    # The constants are written too: a literal would be folded out of every join key and leave nested loops.
    rows = (firsts.repartition(entity).join(labels, entity).select(entity, "label", time, *chosen)
            .withColumns({c: F.lit(v) for c, v in columns.items()}).checkpoint(eager=True))
    cells = rows.select(*columns, entity, "label", time, F.explode(values).alias("_field", "value")).where(F.col("value").isNotNull())
    return cells.select(time, F.concat_ws("_", entity, "label", "_field").alias("column"), "value", *columns), target_column


def forecast_frames(cells: DataFrame, target_column: str, cols: Columns = Columns()) -> tuple[DataFrame, DataFrame]:
    """M6: the target on the whole calendar of the cells of its series, and all other columns as cells."""
    days = cells.groupBy(cols.id).agg(F.min(cols.time).alias("lo"), F.max(cols.time).alias("hi"))
    grid = days.select(cols.id, panel.calendar_days(F.col("lo"), F.col("hi"), name=cols.time))
    own = cells.where(F.col("column") == target_column).select(cols.id, cols.time, F.col("value").alias(cols.target))
    return grid.join(own, [cols.id, cols.time], "left"), cells.where(F.col("column") != target_column)


def run_query(long_df: DataFrame, query: QuerySpec, split: SplitSpec, specs: Sequence[ForecastSpec],
              cols: Columns = Columns(), series_id: str = "1") -> tuple[DataFrame, DataFrame]:
    """(forecasts of every variant, truth) of a query, split and model spec over one panel.

    The panel's rows are written once to the shared folder; every variant reads their cells there.
    """
    cells, target = query_cells(long_df, query, **{cols.id: series_id})
    frame, others = forecast_frames(cells, target, cols)
    frame = forecast_input(frame, cols).checkpoint(eager=True)
    context = panel.select_window(frame, split.windows["context"], cols.time)
    test = panel.select_window(frame, split.windows["validation"], cols.time)
    return run_variants(context, test, specs, cols, cells=others), test


def run_variant(spec: ForecastSpec, context: DataFrame, future: DataFrame | None,
                cols: Columns = Columns(), cells: DataFrame | None = None) -> DataFrame:
    if spec.method == "pooled_ar":
        return forecast_ar(context, spec.horizon, cols, spec.levels, spec.lags, spec.batch_size, spec.step, spec.quantile_method)
    if spec.method == "direct":
        return forecast_direct(context, future, spec.horizon, spec.covariates, cols, spec.levels, spec.batch_size,
                               spec.step, spec.quantile_method)
    if spec.method == "ridge":
        if future is None:
            raise ValueError(f"{spec.name}: covariate methods need known-future rows")
        return forecast_ridge(context, future, spec.covariates, cols, spec.levels, spec.screen, spec.ridge,
                              spec.quantile_method, cells=cells, horizon=spec.horizon)
    if spec.method in ("ols", "pooled_ols"):
        if future is None:
            raise ValueError(f"{spec.name}: covariate methods need known-future rows")
        return forecast_ols(context, future, spec.covariates, cols, spec.levels,
                            batch_size=spec.batch_size if spec.method == "pooled_ols" else None,
                            quantile_method=spec.quantile_method, horizon=spec.horizon)
    return forecast_univariate(context, spec.method, spec.horizon, cols, spec.levels, spec.season,
                               spec.step, spec.quantile_method)


def run_variants(context: DataFrame, test: DataFrame, specs: Sequence[ForecastSpec] = DEFAULT_VARIANTS,
                 cols: Columns = Columns(), cells: DataFrame | None = None) -> DataFrame:
    """Every variant over the same context, labelled and stacked.

    ``cells`` are the covariates of "ridge" in long form, where the panel has too many for columns.
    """
    out = {}
    for s in specs:
        fut = future_frame(test, s.horizon, cols) if s.method in ("ols", "pooled_ols", "direct", "ridge") else None
        out[s.name] = run_variant(s, context, fut, cols, cells)
    return combine(out)


def forecast_and_score(context: DataFrame, test: DataFrame,
                       specs: Sequence[ForecastSpec] = DEFAULT_VARIANTS, cols: Columns = Columns(),
                       null_policy: str = "propagate") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entry 2: (combined forecasts, per-model metrics, long metrics)."""
    combined = run_variants(context, test, specs, cols)
    scores = score(combined, test, cols, null_policy)
    return combined, scores, score_long(scores)


def build_holidays(start: str | Column, end: str | Column, out_dir: str | None = None,
                   spark=None) -> tuple[DataFrame, DataFrame]:
    """Entry 3: US (public + unofficial) and NYSE tables over one set of union dates."""
    cal = holiday_calendar(start, end, spark=spark)
    us = cal.select("timestamp", "publicHolidaysUS", "unofficialHolidaysUS")
    nyse = cal.select("timestamp", "financialHolidaysNYSE")
    if out_dir:
        for name, df in (("us_holidays", us), ("nyse_holidays", nyse)):
            write_ordered(df, f"{out_dir}/{name}.parquet", ["timestamp"], partitions=1)
            write_ordered(df, f"{out_dir}/{name}.csv", ["timestamp"], fmt="csv", partitions=1)
    return us, nyse


def round_doubles(df: DataFrame, digits: int = 6, stable: bool = True) -> DataFrame:
    """Round every double column (comparison-friendly output; tie-stable by default)."""
    rnd = (lambda c: stable_round(c, digits)) if stable else (lambda c: F.round(c, digits))
    return df.select(*[rnd(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])
