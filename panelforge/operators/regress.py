"""Regression forecasters beyond known-future least squares.

direct   covariates known in the context only: one fit per (unit, step ahead)
ar       no covariates: an autoregression pooled over a batch of series
ridge    hundreds of covariates, fewer rows than columns, gaps anywhere

All keep the output contract of ``operators.forecast``.  ``direct`` and ``ar``
shift by row, so they need a dense calendar (``panel.densify``) and raise
where a series has a gap.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import add_steps, time_index
from ..session import ensure_checkpoint_dir
from .forecast import DEFAULT_LEVELS, Columns, _assemble, _linear, _quantile_offsets, _ship_by_value, ols_params, time_grid
from .index import batch_groups


def _dense(df: DataFrame, cols: Columns, step: str) -> DataFrame:
    """Adds each series' last time ``_T`` and fails where rows and calendar differ in number."""
    part = Window.partitionBy(cols.id)
    first, last = F.min(cols.time).over(part), F.max(cols.time).over(part)
    gap = F.raise_error(F.concat(F.lit("series is not dense (use densify): "), F.col(cols.id).cast("string")))
    whole = F.round(time_index(F.col("_T"), step) - time_index(F.col("_t0"), step)) + 1 == F.col("_n")
    return (df.withColumn("_T", last).withColumn("_t0", first).withColumn("_n", F.count(F.lit(1)).over(part))
            .where(F.when(whole, True).otherwise(gap.cast("boolean"))).drop("_t0", "_n"))


def _with_unit(df: DataFrame, groups: DataFrame | None, key: str) -> DataFrame:
    return df.withColumn("_unit", F.col(key)) if groups is None else df.join(groups, key)


# --------------------------------------------------------------------- direct


def forecast_direct(context: DataFrame, future: DataFrame | None, horizon: int, covariates: Sequence[str] | None = None,
                    cols: Columns = Columns(), levels: Sequence[float] = DEFAULT_LEVELS, batch_size: int | None = None,
                    step: str = "day", quantile_method: str = "exact", target_name: str | None = None) -> DataFrame:
    """T2/J7 with past-only covariates: for each step k = 1..horizon least squares of y(t + k) on the
    covariates known at t and on the known-future covariates of t + k.

    Covariates default to all further columns of the context; one that the future frame holds too is
    known-future, any other past-only.  The lags of all steps come from one window over each series
    (one shuffle by series); the statistics per (unit, step) reuse that partitioning when the unit is
    the series.  With ``batch_size`` the fits are pooled over batches of series.  Quantiles are the
    residuals of the same step, so they widen with the step where the data do.  Predictions are NULL
    where a covariate of the origin or of the step is missing, or the fit is singular.
    """
    i, t, y = cols.id, cols.time, cols.target
    name = target_name or y
    ahead = [] if future is None else future.columns
    xs = [c for c in context.columns if c not in (i, t, y)] if covariates is None else list(covariates)
    known, past = [x for x in xs if x in ahead], [x for x in xs if x not in ahead]
    if not xs:
        raise ValueError("no covariates: use forecast_ar")
    ctx = _dense(context.select(i, t, y, *xs).where(F.col(i).isNotNull() & F.col(t).isNotNull()), cols, step)
    groups = batch_groups(ctx, i, batch_size, out="_unit") if batch_size else None
    series = Window.partitionBy(i).orderBy(t)
    lagged = [F.struct(F.lit(k).alias("_k"), *[F.lag(z, k).over(series).alias(f"_z{j}") for j, z in enumerate(past)])
              for k in range(1, horizon + 1)]
    rows = (ctx.select(i, t, y, *known, F.array(*lagged).alias("_l")).select(i, t, y, *known, F.explode("_l").alias("_s"))
            .select(i, y, *[F.col(x).alias(f"_x{j}") for j, x in enumerate(known)], "_s.*"))
    features = [f"_x{j}" for j in range(len(known))] + [f"_z{j}" for j in range(len(past))]
    rows = _with_unit(rows, groups, i).drop(i)
    unit = ["_unit", "_k"]
    params = ols_params(rows, unit, y, features)
    offs = (rows.join(params, unit).groupBy(*unit)
            .agg(_quantile_offsets(F.col(y) - _linear(features), levels, quantile_method).alias("_off")))
    # Not an equality: the optimizer would put t for _T into the density check and fail on every other row.
    origin = ctx.where(F.col(t) >= F.col("_T")).select(i, "_T", *[F.col(z).alias(f"_z{j}") for j, z in enumerate(past)])
    grid = _with_unit(time_grid(origin, horizon, cols, step, keep=[f"_z{j}" for j in range(len(past))]), groups, i)
    if known:
        grid = grid.join(future.select(i, t, *[F.col(x).alias(f"_x{j}") for j, x in enumerate(known)]), [i, t], "left")
    points = (grid.join(params, unit, "left").join(offs, unit, "left")
              .select(i, t, _linear(features).alias("predictions"), "_off"))
    return _assemble(points, cols, levels, name)


# ---------------------------------------------------------- pooled autoregression


def forecast_ar(context: DataFrame, horizon: int, cols: Columns = Columns(), levels: Sequence[float] = DEFAULT_LEVELS,
                lags: Sequence[int] = (1, 7), batch_size: int | None = 100, step: str = "day",
                quantile_method: str = "exact", target_name: str | None = None) -> DataFrame:
    """T3 for bare series: y(t) = a + sum of b_j y(t - lag_j), fitted over all series of a batch at once.

    Every series is divided by its mean absolute value first, so that the batch shares one shape;
    ``batch_size=None`` fits each series alone.  The lags come from one window over each series; the
    statistics are pooled per batch with partial aggregation.  The forecast is a fold over an array of
    the last values: each step reads the values before it, given or forecast.  Gaps among a series'
    last values count as its mean.  Quantiles are the pooled one-step residuals in the series' own
    scale.  A series without a value, or of zeros only, is forecast as NULL.
    """
    i, t, y = cols.id, cols.time, cols.target
    name = target_name or y
    depth = max(lags)
    part = Window.partitionBy(i)
    series = part.orderBy(t)
    ctx = _dense(context.select(i, t, y).where(F.col(i).isNotNull() & F.col(t).isNotNull()), cols, step)
    scale = F.nullif(F.avg(F.abs(F.col(y))).over(part), F.lit(0.0))
    scaled = ctx.select(i, t, "_T", scale.alias("_c"), F.avg(y).over(part).alias("_m"), F.col(y).alias("_y")).select(
        i, t, "_T", "_c", (F.col("_m") / F.col("_c")).alias("_m"), (F.col("_y") / F.col("_c")).alias("_y"))
    lagged = scaled.select("*", *[F.lag("_y", k).over(series).alias(f"_x{j}") for j, k in enumerate(lags)])
    groups = batch_groups(ctx, i, batch_size, out="_unit") if batch_size else None
    # The fit, its residuals and the tails read it: computed once.
    ensure_checkpoint_dir(context.sparkSession)
    lagged = _with_unit(lagged, groups, i).checkpoint(eager=True)
    xs = [f"_x{j}" for j in range(len(lags))]
    params = ols_params(lagged, "_unit", "_y", xs)
    offs = (lagged.join(params, "_unit").groupBy("_unit")
            .agg(_quantile_offsets(F.col("_y") - _linear(xs), levels, quantile_method).alias("_off")))
    back = F.round(time_index(F.col("_T"), step) - time_index(F.col(t), step))
    # The last ``depth`` values of a series, oldest first: a bounded list.
    tail = (lagged.where(back < depth).groupBy(i, "_unit", "_T", "_c", "_m")
            .agg(F.array_sort(F.collect_list(F.struct(F.col(t).alias("t"), F.coalesce("_y", "_m").alias("v")))).alias("_h")))
    fitted = tail.join(params, "_unit", "left").join(offs, "_unit", "left")

    def value(acc: Column, lag: int) -> Column:  # a series shorter than the lag counts as its mean there
        return F.coalesce(F.get(acc, F.size(acc) - lag), F.col("_m"))

    def forward(acc: Column, _k: Column) -> Column:
        ahead = F.col("_a")
        for j, lag in enumerate(lags):
            ahead = ahead + F.col(f"_b{j}") * value(acc, lag)
        return F.concat(acc, F.array(ahead))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.transform("_h", lambda s: s["v"]), forward)
    out = fitted.select(i, "_T", "_c", "_off", F.posexplode(F.slice(path, F.size("_h") + 1, horizon)).alias("_k", "_p"))
    points = out.select(i, add_steps("_T", F.col("_k") + 1, step).alias(t), (F.col("_p") * F.col("_c")).alias("predictions"),
                        F.transform("_off", lambda q: q * F.col("_c")).alias("_off"))
    return _assemble(points, cols, levels, name)


# ------------------------------------------------------------- many covariates


#: Windows and coefficients of up to this many rows are sent to all tasks, so that the cells stay where they are.
BROADCAST_ROWS = 1_000_000
#: Cells (at least) that a task multiplies at once, and numbers in a piece of the sum of products.
BLOCK_CELLS, PIECE = 1_000_000, 8192


def _small(df: DataFrame) -> DataFrame:
    """``df``, broadcast where it has few rows; counting them reads it once more."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def cells_of(df: DataFrame, covariates: Sequence[str], cols: Columns = Columns()) -> DataFrame:
    """Wide covariates as long cells ``id, time, column, value``; missing values give no row."""
    named = F.map_from_arrays(F.array(*[F.lit(c) for c in covariates]), F.array(*[F.col(f"`{c}`").cast("double") for c in covariates]))
    return df.select(cols.id, cols.time, F.explode(named).alias("column", "value")).where(F.col("value").isNotNull())


def ridge_coefficients(target: DataFrame, cells: DataFrame, cols: Columns = Columns(), screen: int | None = None, ridge: float = 0.1) -> DataFrame:
    """``id, column, _mean, _sd, _b, _my``: ridge least squares of the target on the columns of its series.

    Columns are scaled to mean 0 and deviation 1 over their own values, a missing value counting as 0
    (the mean), so the statistics are sums over the cells that exist.  With n valued days,
    (Z'Z + ridge * n * I) b = Z'(y - mean y); it has one solution however few the days are.  All columns
    that move take part (``_whole``).  ``screen`` is a caller's own choice of a smaller model: the
    ``screen`` columns with the largest |sum of z * (y - mean y)| over valued days (ties: by name), whose
    system, at most ``screen`` rows and columns a series, is solved in a task.
    """
    i, t, y = cols.id, cols.time, cols.target
    ensure_checkpoint_dir(target.sparkSession)
    my = target.where(F.col(y).isNotNull()).groupBy(i).agg(F.avg(y).alias("_my"), F.count(y).cast("double").alias("_ny"))
    centred = target.where(F.col(y).isNotNull()).join(my, i).select(i, t, (F.col(y) - F.col("_my")).alias("_yc"))
    if screen is None:
        centred = centred.withColumn("_k", F.row_number().over(Window.partitionBy(i).orderBy(t)) - 1)
    both = cells.join(_small(centred), [i, t], "left")
    stats = both.groupBy(i, "column").agg(F.avg("value").alias("_mean"), F.stddev_pop("value").alias("_sd"),
                                          F.sum(F.col("value") * F.col("_yc")).alias("_vy"),
                                          F.sum(F.when(F.col("_yc").isNotNull(), F.col("_yc"))).alias("_sy"),
                                          F.count("_yc").alias("_m"))
    cov = ((F.col("_vy") - F.col("_mean") * F.col("_sy")) / F.col("_sd")).alias("_c")
    moving = stats.where((F.col("_sd") > 0) & F.col("_vy").isNotNull()).select(i, "column", "_mean", "_sd", cov, "_m")
    if screen is None:
        return _whole(both, centred, moving, my, cols, ridge).join(my.select(i, "_my"), i)
    moving = moving.drop("_m")
    best = Window.partitionBy(i).orderBy(F.abs("_c").desc(), "column")
    # Bounded by the row number itself: Spark then keeps ``screen`` rows a series and task before they meet.
    chosen = (moving.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= screen)
              .withColumn("_r", F.col("_r") - 1).checkpoint(eager=True))
    z = (both.where(F.col("_yc").isNotNull()).join(_small(chosen), [i, "column"])
         .select(i, t, "_r", ((F.col("value") - F.col("_mean")) / F.col("_sd")).alias("_z")))
    # At most ``screen`` cells a day; their products add up to Z'Z.
    day = z.groupBy(i, t).agg(F.collect_list(F.struct("_r", "_z")).alias("_d"))
    products = F.flatten(F.transform("_d", lambda a: F.transform(F.filter("_d", lambda b: b["_r"] <= a["_r"]), lambda b: F.struct(
        a["_r"].alias("p"), b["_r"].alias("q"), (a["_z"] * b["_z"]).alias("v")))))
    gram = (day.select(i, F.explode(products).alias("s")).groupBy(i, F.col("s.p").alias("p"), F.col("s.q").alias("q"))
            .agg(F.sum("s.v").alias("v")).groupBy(i).agg(F.collect_list(F.struct("p", "q", "v")).alias("_g")))
    right = chosen.groupBy(i).agg(F.collect_list(F.struct(F.col("_r").alias("r"), F.col("_c").alias("c"))).alias("_right"))
    system = gram.join(right, i).join(my, i)

    def solve(batches):
        for pdf in batches:
            out = []
            for key, g, rhs, n in zip(pdf[i], pdf["_g"], pdf["_right"], pdf["_ny"], strict=True):
                m = len(rhs)
                a, b = np.zeros((m, m)), np.zeros(m)
                for e in g:
                    a[e["p"], e["q"]] = a[e["q"], e["p"]] = e["v"]
                for e in rhs:
                    b[e["r"]] = e["c"]
                beta = np.linalg.solve(a + ridge * n * np.eye(m), b)
                out.append(pd.DataFrame({i: [key] * m, "_r": np.arange(m), "_b": beta}))
            if out:
                yield pd.concat(out)

    _ship_by_value()
    kind = system.schema[i].dataType.simpleString()
    solved = system.select(i, "_g", "_right", "_ny").mapInPandas(solve, f"`{i}` {kind}, _r int, _b double")
    return chosen.join(solved, [i, "_r"]).join(my.select(i, "_my"), i).select(i, "column", "_mean", "_sd", "_b", "_my")


def _whole(both: DataFrame, centred: DataFrame, moving: DataFrame, my: DataFrame, cols: Columns, ridge: float) -> DataFrame:
    """``id, column, _mean, _sd, _b`` of all ``moving`` columns: the fit of ``ridge_coefficients`` without a screen.

    The system stands on the shorter side of Z (valued days by columns): Z'Z where a series has no more
    columns than valued days, else (ZZ' + ridge * n * I) w = y - mean y over the days, and b = Z'w, which is
    the same solution.  The products are summed over blocks of the longer side, block by block in tasks and
    then piece by piece, so that only the shorter side squared has to fit in a task.
    """
    i, t = cols.id, cols.time
    columns = moving.withColumn("_r", F.monotonically_increasing_id()).checkpoint(eager=True)
    sizes = (columns.groupBy(i).agg(F.count(F.lit(1)).alias("_p"), F.sum("_m").alias("_cells")).join(my.select(i, "_ny"), i)
             .withColumn("_side", F.least(F.col("_p"), F.col("_ny").cast("bigint"))))
    blocks = F.ceil(F.col("_cells") / F.greatest(F.lit(BLOCK_CELLS), F.col("_side") * F.col("_side") / 8))
    sizes = sizes.withColumn("_blocks", F.greatest(blocks, F.lit(1)))
    sized = columns.join(sizes, i)
    # Only few columns, no more than days, are numbered; a NULL number stands for the system over days.
    few = sized.where(F.col("_p") <= F.col("_ny")).withColumn("_q", F.row_number().over(Window.partitionBy(i).orderBy("column")) - 1)
    many = sized.where(F.col("_p") > F.col("_ny")).withColumn("_q", F.lit(None).cast("int"))
    columns = few.unionByName(many).select(i, "column", "_mean", "_sd", "_c", "_r", "_side", "_blocks", "_q").checkpoint(eager=True)
    by_day = F.col("_q").isNull()
    z = (both.where(F.col("_yc").isNotNull()).join(_small(columns.drop("_c")), [i, "column"])
         .select(i, "_side", F.coalesce("_q", "_k").alias("_s"), F.when(by_day, F.col("_r")).otherwise(F.col("_k")).alias("_l"),
                 "_blocks", ((F.col("value") - F.col("_mean")) / F.col("_sd")).alias("_z"))
         .withColumn("_block", F.pmod(F.xxhash64("_l"), F.col("_blocks"))).drop("_blocks"))

    def products(key, table):
        m = key[1].as_py()
        short, z = table.column("_s").to_numpy(), table.column("_z").to_numpy()
        lines, place = np.unique(table.column("_l").to_numpy(), return_inverse=True)
        order = np.argsort(place, kind="stable")
        short, z, place = short[order], z[order], place[order]
        gram, step = np.zeros((m, m)), max(1, 2_000_000 // m)
        for lo in range(0, len(lines), step):
            a, b = np.searchsorted(place, [lo, lo + step])
            dense = np.bincount((place[a:b] - lo) * m + short[a:b], z[a:b], step * m).reshape(step, m)
            gram += dense.T @ dense
        packed = gram[np.tril_indices(m)]
        pieces = [packed[at:at + PIECE].tobytes() for at in range(0, len(packed), PIECE)]
        head = [pa.array([k.as_py()] * len(pieces), k.type) for k in key[:2]]
        return pa.Table.from_arrays([*head, pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.binary())], names=[i, "_side", "_piece", "_v"])

    def total(key, table):
        v = sum(np.frombuffer(x.as_buffer()) for x in table.column("_v"))
        return pa.Table.from_arrays([*[pa.array([k.as_py()], k.type) for k in key], pa.array([v.tobytes()], pa.binary())], names=[i, "_side", "_piece", "_v"])

    def solve(key, pieces, right):
        m = right.num_rows
        at = right.column("_s").to_numpy()
        packed = pieces.sort_by("_piece").column("_v")
        a, b = np.zeros((m, m)), np.zeros(m)
        a[np.tril_indices(m)] = np.concatenate([np.frombuffer(x.as_buffer()) for x in packed])
        a += np.tril(a, -1).T
        a[np.diag_indices(m)] += ridge * right.column("_ny")[0].as_py()
        b[at] = right.column("_y").to_numpy()
        return pa.Table.from_arrays([right.column(i), right.column("_s"), pa.array(np.linalg.solve(a, b)[at])], names=[i, "_s", "_w"])

    _ship_by_value()
    kind = columns.schema[i].dataType.simpleString()
    piece = f"`{i}` {kind}, _side bigint, _piece int, _v binary"
    sums = z.groupBy(i, "_side", "_block").applyInArrow(products, piece).groupBy(i, "_side", "_piece").applyInArrow(total, piece)
    days = centred.join(sizes.where(F.col("_p") > F.col("_ny")), i).select(i, F.col("_k").alias("_s"), F.col("_yc").alias("_y"), "_ny")
    own = columns.where(~by_day).join(my, i).select(i, F.col("_q").alias("_s"), F.col("_c").alias("_y"), "_ny")
    # Read for its size and for the fit.
    solved = (sums.groupBy(i).cogroup(days.unionByName(own).groupBy(i))
              .applyInArrow(solve, f"`{i}` {kind}, _s int, _w double").checkpoint(eager=True))
    weights = centred.join(solved, (centred[i] == solved[i]) & (centred["_k"] == solved["_s"])).select(centred[i], t, "_w")
    out = [i, "column", "_mean", "_sd", "_b"]
    spread = (both.drop("_yc", "_k").join(_small(weights), [i, t]).groupBy(i, "column")
              .agg(F.sum(F.col("value") * F.col("_w")).alias("_vw"), F.sum("_w").alias("_sw")))
    over_days = (columns.where(by_day).join(spread, [i, "column"])
                 .withColumn("_b", (F.col("_vw") - F.col("_mean") * F.col("_sw")) / F.col("_sd")).select(*out))
    direct = columns.where(~by_day).withColumn("_s", F.col("_q")).join(solved, [i, "_s"]).withColumnRenamed("_w", "_b").select(*out)
    return over_days.unionByName(direct)


def _ridge_points(days: DataFrame, cells: DataFrame, coef: DataFrame, cols: Columns) -> DataFrame:
    """Fitted value of every row of ``days``: the mean plus what the day's cells add."""
    i, t = cols.id, cols.time
    add = (cells.join(_small(coef), [i, "column"]).groupBy(i, t)
           .agg(F.sum(F.col("_b") * (F.col("value") - F.col("_mean")) / F.col("_sd")).alias("_add")))
    mean = coef.groupBy(i).agg(F.max("_my").alias("_my"))
    return days.join(mean, i, "left").join(add, [i, t], "left").withColumn("predictions", F.col("_my") + F.coalesce("_add", F.lit(0.0)))


def forecast_ridge(context: DataFrame, future: DataFrame, covariates: Sequence[str] | None = None, cols: Columns = Columns(),
                   levels: Sequence[float] = DEFAULT_LEVELS, screen: int | None = None, ridge: float = 0.1, quantile_method: str = "exact",
                   target_name: str | None = None, cells: DataFrame | None = None, horizon: int | None = None) -> DataFrame:
    """T2/P16 with any number of covariates: all columns that context and future share, or long ``cells``.

    ``cells`` (``id, column, value`` by time, over both windows) stands in for wide columns, so that a
    panel of many thousand columns needs no wide frame.  See ``ridge_coefficients`` for the fit.
    ``horizon`` is checked against the rows that the future frame holds for a series.
    """
    i, t, y = cols.id, cols.time, cols.target
    if cells is None:
        xs = [c for c in context.columns if c in future.columns and c not in (i, t, y)] if covariates is None else list(covariates)
        if not xs:
            raise ValueError("no covariates shared by context and future frames")
        before, after = cells_of(context, xs, cols), cells_of(future, xs, cols)
    else:
        before = cells.join(_small(context.select(i, t)), [i, t], "left_semi")
        after = cells.join(_small(future.select(i, t)), [i, t], "left_semi")
    future = future.select(i, t)
    if horizon is not None:
        steps = F.count(F.lit(1)).over(Window.partitionBy(i))
        short = F.raise_error(F.concat(F.lit(f"fewer than {horizon} future rows for series "), F.col(i).cast("string")))
        future = future.withColumn("_n", steps).where(F.when(F.col("_n") < horizon, short.cast("boolean")).otherwise(True)).drop("_n")
    # A row a column of the fit, read for the residuals and for the forecast.
    ensure_checkpoint_dir(context.sparkSession)
    coef = ridge_coefficients(context.select(i, t, y), before, cols, screen, ridge).checkpoint(eager=True)
    fitted = _ridge_points(context.select(i, t, y), before, coef, cols)
    offs = fitted.groupBy(i).agg(_quantile_offsets(F.col(y) - F.col("predictions"), levels, quantile_method).alias("_off"))
    points = _ridge_points(future, after, coef, cols).join(offs, i, "left")
    return _assemble(points.select(i, t, "predictions", "_off"), cols, levels, target_name or y)
