"""Forecast operators.

The reference calls a pretrained network through ``predict_df``.  The
operator around it — fit per series key, predict a horizon, attach quantile
levels, optionally pool series into batches — is rebuilt here with
statistical methods of our own choice, all distributed by series key:

univariate  naive, seasonal_naive(m), mean, drift, trend   (T1)
covariates  ols on known-future covariates                 (T2, J7)
pooled      ols fitted per batch of ``batch_size`` series  (T3)
plug-in     any pandas model per batch group               (T7, V4)

Output contract (M8): ``id, timestamp, target_name, predictions, q…``; the
quantile columns are named ``q10, q50, q90`` internally (``0.1`` … on export).
Quantiles are the point forecast plus the exact percentile (linear
interpolation) of the in-sample one-step residuals of the fit unit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import add_steps, time_index
from .index import batch_groups, row_groups


def _ship_by_value() -> None:
    """Pickle this package's functions by value inside Python UDFs.

    Executors then need no copy of the package on their path; only numpy and
    pandas, which PySpark's Arrow path requires anyway.
    """
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__.split(".")[0]])

DEFAULT_LEVELS = (0.1, 0.5, 0.9)


def qname(level: float) -> str:
    """0.1 -> ``q10``, 0.025 -> ``q2_5``."""
    return "q" + f"{level * 100:g}".replace(".", "_")


def export_names(levels: Sequence[float] = DEFAULT_LEVELS) -> dict[str, str]:
    """Internal quantile names -> the literal names of the reference output (``0.1``)."""
    return {qname(q): f"{q:g}" for q in levels}


@dataclass(frozen=True)
class Columns:
    id: str = "id"
    time: str = "timestamp"
    target: str = "y"


# ----------------------------------------------------------------------- helpers


def time_grid(last: DataFrame, horizon: int, cols: Columns = Columns(), step: str = "day",
              last_col: str = "_T", keep: Sequence[str] = ()) -> DataFrame:
    """T5: ``id, _k, timestamp`` (+ ``keep`` columns carried along) for steps
    1..horizon after each series' last time: a generator, no join."""
    return (last.select(cols.id, last_col, *keep,
                        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_k"))
            .select(cols.id, "_k", add_steps(last_col, "_k", step).alias(cols.time), *keep))


def future_frame(test: DataFrame, horizon: int, cols: Columns = Columns()) -> DataFrame:
    """Test rows without the target, first ``horizon`` rows per series."""
    w = Window.partitionBy(cols.id).orderBy(cols.time)
    return (test.drop(cols.target)
            .withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= horizon).drop("_rn"))


def _quantile_offsets(resid: Column, levels: Sequence[float], method: str = "exact",
                      accuracy: int = 10000) -> Column:
    lv = F.array(*[F.lit(float(q)) for q in levels])
    if method == "exact":
        return F.percentile(resid, lv)
    if method == "approx":
        return F.percentile_approx(resid, lv, accuracy).cast("array<double>")
    raise ValueError("quantile method must be 'exact' or 'approx'")


def _assemble(points: DataFrame, cols: Columns, levels: Sequence[float], target_name: str) -> DataFrame:
    """``points`` holds id, timestamp, predictions, _off (array) -> M8 rows."""
    qcols = [(F.col("predictions") + F.col("_off")[i]).alias(qname(q)) for i, q in enumerate(levels)]
    return points.select(cols.id, cols.time, F.lit(target_name).alias("target_name"),
                         "predictions", *qcols)


# -------------------------------------------------------------------- univariate


def forecast_univariate(context: DataFrame, method: str, horizon: int, cols: Columns = Columns(),
                        levels: Sequence[float] = DEFAULT_LEVELS, season: int = 7, step: str = "day",
                        quantile_method: str = "exact", target_name: str | None = None) -> DataFrame:
    """Per-series univariate forecast with quantiles.

    One windowed pass per series key (an exchange on ``id`` plus a sort)
    computes the fit and the residuals; the per-series aggregation that
    follows reuses that partitioning, so each method costs one shuffle of
    the context.  ``seasonal_naive`` needs a dense calendar (``densify``).
    """
    i, t, y = cols.id, cols.time, cols.target
    name = target_name or y
    ctx = context.select(i, t, y).where(F.col(i).isNotNull() & F.col(t).isNotNull())
    part = Window.partitionBy(i)
    ordered = part.orderBy(t)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tx = time_index(t, step)

    if method == "seasonal_naive":
        m = season
        # T is the last time of the series, valued or not (dense calendar).
        win = ctx.select(i, t, y, F.max(t).over(part).alias("_T"),
                         (F.col(y) - F.lag(y, m).over(ordered)).alias("_e"))
        fit = win.groupBy(i).agg(F.max("_T").alias("_T"), F.min(t).alias("_t0"), F.count(F.lit(1)).alias("_n"),
                                 _quantile_offsets(F.col("_e"), levels, quantile_method).alias("_off"))
        # Lags are by row: a gap or a repeated time would shift them.
        gap = F.raise_error(F.concat(F.lit("series is not dense (use densify): "), F.col(i).cast("string")))
        dense = F.round(time_index("_T", step) - time_index("_t0", step)) + 1 == F.col("_n")
        fit = fit.where(F.when(dense, True).otherwise(gap.cast("boolean"))).drop("_t0", "_n")
        back = F.round(time_index("_T", step) - time_index(t, step)).cast("int")  # steps before the origin
        season_vals = (win.where(back < m)
                       .select(i, (F.lit(m) - back).alias("_pos"), F.col(y).alias("predictions")))
        grid = time_grid(fit, horizon, cols, step, keep=["_off"]).withColumn("_pos", (F.col("_k") - 1) % m + 1)
        pts = grid.join(season_vals, [i, "_pos"], "left")
        return _assemble(pts, cols, levels, name)

    # Every method below skips missing targets but keeps the series' last time
    # (valued or not) as the forecast origin, so the horizon lines up with the
    # next window of a dense calendar.
    valued = F.col(y).isNotNull()
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    prev_y = F.last(y, ignorenulls=True).over(before)
    if method == "naive":
        win = ctx.select(i, t, y, (F.col(y) - prev_y).alias("_e"))
        fit = win.groupBy(i).agg(F.max(t).alias("_T"), F.max_by(y, F.when(valued, F.col(t))).alias("_p"),
                                 _quantile_offsets(F.col("_e"), levels, quantile_method).alias("_off"))
        pts = time_grid(fit, horizon, cols, step, keep=["_p", "_off"])
        return _assemble(pts.withColumn("predictions", F.col("_p")), cols, levels, name)

    if method == "mean":
        win = ctx.select(i, t, y, (F.col(y) - F.avg(y).over(part)).alias("_e"))
        fit = win.groupBy(i).agg(F.max(t).alias("_T"), F.avg(y).alias("_p"),
                                 _quantile_offsets(F.col("_e"), levels, quantile_method).alias("_off"))
        pts = time_grid(fit, horizon, cols, step, keep=["_p", "_off"])
        return _assemble(pts.withColumn("predictions", F.col("_p")), cols, levels, name)

    if method == "drift":
        vx = F.when(valued, tx)
        slope = ((F.last(y, ignorenulls=True).over(whole) - F.first(y, ignorenulls=True).over(whole))
                 / F.nullif(F.last(vx, ignorenulls=True).over(whole)
                            - F.first(vx, ignorenulls=True).over(whole), F.lit(0.0)))
        win = ctx.select(i, t, y, vx.alias("_x"), slope.alias("_b"), prev_y.alias("_py"),
                         F.last(vx, ignorenulls=True).over(before).alias("_px"))
        e = (F.col(y) - F.col("_py")) - F.col("_b") * (F.col("_x") - F.col("_px"))
        fit = win.groupBy(i).agg(F.max(t).alias("_T"), F.max_by(y, F.when(valued, F.col(t))).alias("_ly"),
                                 F.max("_x").alias("_lx"), F.max("_b").alias("_b"),
                                 _quantile_offsets(e, levels, quantile_method).alias("_off"))
        pts = time_grid(fit, horizon, cols, step, keep=["_ly", "_lx", "_b", "_off"])
        pts = pts.withColumn("predictions", F.col("_ly") + F.col("_b") * (time_index(t, step) - F.col("_lx")))
        return _assemble(pts, cols, levels, name)

    if method == "trend":
        win = ctx.select(i, t, y, tx.alias("_x"),
                         F.regr_slope(F.col(y), tx).over(part).alias("_b"),
                         F.regr_intercept(F.col(y), tx).over(part).alias("_a"))
        e = F.col(y) - (F.col("_a") + F.col("_b") * F.col("_x"))
        fit = win.groupBy(i).agg(F.max(t).alias("_T"), F.max("_a").alias("_a"), F.max("_b").alias("_b"),
                                 _quantile_offsets(e, levels, quantile_method).alias("_off"))
        pts = time_grid(fit, horizon, cols, step, keep=["_a", "_b", "_off"])
        pts = pts.withColumn("predictions", F.col("_a") + F.col("_b") * time_index(t, step))
        return _assemble(pts, cols, levels, name)

    raise ValueError(f"unknown method {method!r}")


# ----------------------------------------------------------- least squares


def _ols_params_closed(df: DataFrame, unit: Sequence[str], y: str, xs: Sequence[str]) -> DataFrame:
    """k <= 2: slopes and intercept from population (co)variances, NULL when singular."""
    if len(xs) == 1:
        x = xs[0]
        return df.groupBy(*unit).agg(F.regr_intercept(y, x).alias("_a"), F.regr_slope(y, x).alias("_b0"))
    x, z = xs
    g = df.groupBy(*unit).agg(
        F.var_pop(x).alias("vx"), F.var_pop(z).alias("vz"), F.covar_pop(x, z).alias("cxz"),
        F.covar_pop(x, y).alias("cxy"), F.covar_pop(z, y).alias("czy"),
        F.avg(x).alias("mx"), F.avg(z).alias("mz"), F.avg(y).alias("my"))
    # Singular in relation to the covariates' own scales.
    det = F.expr("CASE WHEN vx * vz - cxz * cxz > 1e-10 * vx * vz THEN vx * vz - cxz * cxz END")
    b0 = (F.col("cxy") * F.col("vz") - F.col("czy") * F.col("cxz")) / det
    b1 = (F.col("czy") * F.col("vx") - F.col("cxy") * F.col("cxz")) / det
    return g.select(*unit, b0.alias("_b0"), b1.alias("_b1"), "mx", "mz", "my").select(
        *unit, (F.col("my") - F.col("_b0") * F.col("mx") - F.col("_b1") * F.col("mz")).alias("_a"),
        "_b0", "_b1")


def _ols_params_solve(df: DataFrame, unit: Sequence[str], y: str, xs: Sequence[str]) -> DataFrame:
    """k > 2: centred statistics per unit in Catalyst, correlation matrices solved a batch at a time in numpy."""
    k = len(xs)
    aggs = [F.avg(c).alias(f"m{j}") for j, c in enumerate([*xs, y])]
    aggs += [F.stddev_pop(c).alias(f"d{j}") for j, c in enumerate(xs)]
    aggs += [F.covar_pop(xs[a], ([*xs, y])[b]).alias(f"c{a}_{b}") for a in range(k) for b in range(a + 1, k + 1)]
    stats = df.groupBy(*unit).agg(*aggs)
    schema = ", ".join(f"`{u}` {stats.schema[u].dataType.simpleString()}" for u in unit) + ", _a double, " + ", ".join(f"_b{j} double" for j in range(k))

    def solve(batches):
        for pdf in batches:
            get = lambda c: pdf[c].to_numpy(dtype=float)
            sd = np.stack([get(f"d{j}") for j in range(k)], 1)
            corr = np.ones((len(pdf), k, k))
            right = np.empty((len(pdf), k))
            with np.errstate(all="ignore"):
                for a in range(k):
                    right[:, a] = get(f"c{a}_{k}") / sd[:, a]
                    for b in range(a + 1, k):
                        corr[:, a, b] = corr[:, b, a] = get(f"c{a}_{b}") / (sd[:, a] * sd[:, b])
            ok = np.isfinite(corr).all((1, 2)) & np.isfinite(right).all(1)
            if ok.any():
                ok[ok] = np.linalg.eigvalsh(corr[ok])[:, 0] > 1e-10
            beta = np.full((len(pdf), k), np.nan)
            if ok.any():
                beta[ok] = np.linalg.solve(corr[ok], right[ok][..., None])[..., 0] / sd[ok]
            mean = np.stack([get(f"m{j}") for j in range(k)], 1)
            out = {u: pdf[u].to_numpy() for u in unit} | {"_a": get(f"m{k}") - (beta * mean).sum(1)}
            yield pd.DataFrame(out | {f"_b{j}": beta[:, j] for j in range(k)})

    _ship_by_value()
    params = stats.mapInPandas(solve, schema)
    return params.select(*unit, *[F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c)
                                 for c in ["_a"] + [f"_b{j}" for j in range(k)]])


def ols_params(df: DataFrame, unit: str | Sequence[str], y: str, xs: Sequence[str]) -> DataFrame:
    """Fit ``y = a + sum(b_j x_j)`` per unit (one column or several) over complete rows: ``unit, _a, _b0..``."""
    unit = [unit] if isinstance(unit, str) else list(unit)
    cond = F.col(y).isNotNull()
    for x in xs:
        cond = cond & F.col(x).isNotNull()
    rows = df.where(cond)
    if len(xs) <= 2:
        return _ols_params_closed(rows, unit, y, xs)
    return _ols_params_solve(rows, unit, y, xs)


def _linear(xs: Sequence[str]) -> Column:
    pred = F.col("_a")
    for j, x in enumerate(xs):
        pred = pred + F.col(f"_b{j}") * F.col(x)
    return pred


def forecast_ols(context: DataFrame, future: DataFrame | None, covariates: Sequence[str] | None = None,
                 cols: Columns = Columns(), levels: Sequence[float] = DEFAULT_LEVELS,
                 batch_size: int | None = None, quantile_method: str = "exact",
                 target_name: str | None = None, horizon: int | None = None) -> DataFrame:
    """T2/J7 (per series) and T3 (``batch_size``: pooled per batch of sorted series).

    Covariates default to the columns present in both frames (known-future
    covariates, J7).  Parameters are one row per fit unit; they are joined
    back to the context for residual quantiles and to the future rows for
    the predictions (Spark broadcasts them when AQE measures them small).

    A covariate that the future frame lacks is known in the context only:
    then each step of the horizon is fitted on its own (``forecast_direct``).
    Without any covariate the series share a pooled autoregression
    (``forecast_ar``).  Both need ``horizon`` and a dense calendar.
    """
    from .regress import forecast_ar, forecast_direct

    i, t, y = cols.id, cols.time, cols.target
    name = target_name or y
    ahead = [] if future is None else future.columns
    if covariates is None:
        covariates = [c for c in context.columns if c in ahead and c not in (i, t, y)]
    xs = list(covariates)
    if not xs or any(x not in ahead for x in xs):
        if horizon is None:
            raise ValueError("horizon is needed where the future frame does not hold every covariate")
        if not xs:
            return forecast_ar(context, horizon, cols, levels, batch_size=batch_size, quantile_method=quantile_method, target_name=target_name)
        return forecast_direct(context, future, horizon, xs, cols, levels, batch_size=batch_size,
                               quantile_method=quantile_method, target_name=target_name)
    ctx = context.select(i, t, y, *xs).where(F.col(i).isNotNull())
    fut = future.select(i, t, *xs).where(F.col(i).isNotNull())
    if horizon is not None:  # every series that has future rows must have them for the whole horizon
        steps = F.count(F.lit(1)).over(Window.partitionBy(i))
        short = F.raise_error(F.concat(F.lit(f"fewer than {horizon} future rows for series "), F.col(i).cast("string")))
        fut = fut.withColumn("_n", steps).where(F.when(F.col("_n") < horizon, short.cast("boolean")).otherwise(True)).drop("_n")
    if batch_size:
        groups = batch_groups(ctx, i, batch_size, out="_unit")
        ctx = ctx.join(groups, i)
        fut = fut.join(groups, i)
        unit = "_unit"
    else:
        unit = i
    params = ols_params(ctx, unit, y, xs)
    resid = (ctx.join(params, unit)
             .select(unit, (F.col(y) - _linear(xs)).alias("_e")))
    offs = resid.groupBy(unit).agg(_quantile_offsets(F.col("_e"), levels, quantile_method).alias("_off"))
    fitted = params.join(offs, unit, "left")
    pts = (fut.join(fitted, unit, "left")
           .select(i, t, _linear(xs).alias("predictions"), "_off"))
    return _assemble(pts, cols, levels, name)


# ------------------------------------------------------------------ plug-in


def apply_model(context: DataFrame, model: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
                schema: str | T.StructType, future: DataFrame | None = None,
                cols: Columns = Columns(), batch_size: int = 100, batch_rows: int | None = None) -> DataFrame:
    """Run any pandas model once per batch of ``batch_size`` sorted series.

    With ``batch_rows`` batches are cut by rows instead: a batch holds less than
    that many context rows and its last series, so long series do not add up.

    The model receives the context rows (and the future rows, possibly
    empty) of one batch and returns forecast rows matching ``schema``.
    Batches bound what one Python worker holds to ``batch_size`` series.
    """
    groups = (row_groups(context, cols.id, batch_rows, out="_batch") if batch_rows
              else batch_groups(context, cols.id, batch_size, out="_batch"))
    ctx = context.join(groups, cols.id)
    if future is None:
        future = context.limit(0).drop(cols.target)
    fut = future.join(groups, cols.id)
    # Both sides may come from one plan: fresh attributes keep the cogroup unambiguous.
    ctx = ctx.select(*[F.col(c).alias(c) for c in ctx.columns])
    fut = fut.select(*[F.col(c).alias(c) for c in fut.columns])

    def run(ctx_pdf: pd.DataFrame, fut_pdf: pd.DataFrame) -> pd.DataFrame:
        return model(ctx_pdf.drop(columns=["_batch"]), fut_pdf.drop(columns=["_batch"]))

    _ship_by_value()

    return ctx.groupBy("_batch").cogroup(fut.groupBy("_batch")).applyInPandas(run, schema)


def weekday_mean_model(horizon: int, levels: Sequence[float] = DEFAULT_LEVELS,
                       cols: Columns = Columns(), target_name: str | None = None):
    """A deterministic plug-in: same-weekday mean, residual quantiles.

    Point at ``T + k`` = mean of the valued context days sharing its weekday;
    quantiles add the linear-interpolated percentiles of ``y - weekday mean``.
    Vectorised over all series of the batch (no per-row Python).
    """
    i, t, y = cols.id, cols.time, cols.target
    name = target_name or y
    qcols = [qname(q) for q in levels]
    levels = list(levels)

    def model(ctx: pd.DataFrame, _fut: pd.DataFrame) -> pd.DataFrame:
        if ctx.empty:
            return pd.DataFrame(columns=[i, t, "target_name", "predictions", *qcols])
        ts = pd.to_datetime(ctx[t])
        last = ts.groupby(ctx[i]).max()
        valued = ctx[y].notna()
        v = pd.DataFrame({"id": ctx[i][valued].to_numpy(), "dow": ts[valued].dt.dayofweek.to_numpy(),
                          "y": ctx[y][valued].to_numpy()})
        means = v.groupby(["id", "dow"])["y"].mean().rename("m")
        v = v.join(means, on=["id", "dow"])
        v["e"] = v["y"] - v["m"]
        offs = v.groupby("id")["e"].quantile(levels).unstack()
        steps = np.arange(1, horizon + 1)
        grid = pd.DataFrame({"id": np.repeat(last.index.to_numpy(), horizon),
                             "d": np.repeat(last.to_numpy(), horizon)
                             + pd.to_timedelta(np.tile(steps, len(last)), unit="D")})
        grid["dow"] = grid["d"].dt.dayofweek
        grid = grid.join(means, on=["id", "dow"]).join(offs, on="id")
        out = pd.DataFrame({i: grid["id"].to_numpy(), t: grid["d"].dt.date.to_numpy(),
                            "target_name": name, "predictions": grid["m"].to_numpy()})
        for q, c in zip(levels, qcols):
            col = grid[q] if q in grid.columns else np.nan
            out[c] = grid["m"].to_numpy() + np.asarray(col, dtype=float)
        return out

    return model


def forecast_schema(id_type: str = "bigint", time_type: str = "date",
                    levels: Sequence[float] = DEFAULT_LEVELS, cols: Columns = Columns()) -> str:
    qs = ", ".join(f"{qname(q)} double" for q in levels)
    return f"{cols.id} {id_type}, {cols.time} {time_type}, target_name string, predictions double, {qs}"
