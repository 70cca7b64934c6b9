"""Regression forecasters, as-of intervals, blocks and ordered sinks against plain Python on small frames."""

from __future__ import annotations

import datetime as dt
import glob
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import panel, regress
from panelforge.operators.asof import asof_join, validity_intervals
from panelforge.operators.forecast import Columns, forecast_ols
from panelforge.operators.index import row_groups
from panelforge.operators.regress import forecast_ar, forecast_direct, forecast_ridge
from panelforge.session import scratch_path
from panelforge.sources.calendars import holiday_calendar
from panelforge.sources.files import read_csv, with_input_order, write_ordered

DAY = dt.date(2024, 1, 1)
COLS = Columns("id", "timestamp", "y")


def day(k):
    return DAY + dt.timedelta(days=k)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def series():
    rng = random.Random(1)
    out = []
    for i in range(4):
        for t in range(40):
            y = None if rng.random() < 0.1 else 10 * (i + 1) + rng.gauss(0, 2) + 3 * (t % 7)
            out.append((i, day(t), y, rng.gauss(0, 1), None if rng.random() < 0.05 else rng.gauss(0, 1), rng.gauss(5, 2)))
    return out


SCHEMA = "id long, timestamp date, y double, a double, b double, c double"


def lstsq(rows):
    x = np.array([[1.0, *r[1:]] for r in rows])
    return np.linalg.lstsq(x, np.array([r[0] for r in rows]), rcond=None)[0]


@pytest.mark.parametrize("batch", [None, 2])
def test_direct_fits_every_step_alone(spark, series, batch):
    df = spark.createDataFrame(series, SCHEMA)
    ctx, fut = df.where(F.col("timestamp") < day(35)), df.where(F.col("timestamp") >= day(35)).drop("y", "a", "b")
    got = {(r.id, r.timestamp): r for r in forecast_ols(ctx, fut, ["a", "b", "c"], COLS, batch_size=batch, horizon=5).collect()}
    assert len(got) == 20
    at = {(i, t): r for r in series for i, t in [(r[0], r[1])]}
    for i in range(4):
        mates = [i] if batch is None else [j for j in range(4) if j // batch == i // batch]
        for k in range(1, 6):
            rows = []
            for j in mates:
                for t in range(k, 35):
                    y, c = at[j, day(t)][2], at[j, day(t)][5]
                    a, b = at[j, day(t - k)][3:5]
                    if None not in (y, a, b, c):
                        rows.append((y, c, a, b))
            beta = lstsq(rows)
            a, b = at[i, day(34)][3:5]
            want = None if b is None else float(beta @ [1, at[i, day(34 + k)][5], a, b])
            resid = [r[0] - float(beta @ [1, *r[1:]]) for r in rows]
            r = got[i, day(34 + k)]
            if want is None:
                assert r.predictions is None
            else:
                assert r.predictions == pytest.approx(want, rel=1e-6)
                assert r.q90 - r.predictions == pytest.approx(np.quantile(resid, 0.9), rel=1e-6, abs=1e-6)


def test_direct_without_a_future_frame_and_with_a_gap(spark, series):
    df = spark.createDataFrame(series, SCHEMA)
    out = forecast_direct(df.select("id", "timestamp", "y", "a"), None, 3, cols=COLS)
    assert out.count() == 12 and out.where("predictions is null").count() == 0
    with pytest.raises(Exception, match="not dense"):
        forecast_direct(df.where(F.col("timestamp") != day(7)), None, 3, ["a"], COLS).collect()
    with pytest.raises(ValueError):
        forecast_ols(df, None, ["a"], COLS)


@pytest.mark.parametrize("lags", [(1,), (1, 7), (1, 2, 7)])
def test_ar_equals_a_plain_loop(spark, series, lags):
    odd = [(8, day(t), 0.0, 0.0, 0.0, 0.0) for t in range(40)] + [(9, day(t), None, 0.0, 0.0, 0.0) for t in range(40)]
    short = [(3 + 4, day(39 - t), 5.0 + t, 0.0, 0.0, 0.0) for t in range(3)]
    df = spark.createDataFrame(series + odd + short, SCHEMA).select("id", "timestamp", "y")
    got = {(r.id, r.timestamp): r.predictions for r in forecast_ar(df, 10, COLS, lags=lags, batch_size=2).collect()}
    by = {i: [r[2] for r in sorted(series + odd + short) if r[0] == i] for i in (0, 1, 2, 3, 7, 8, 9)}
    keys = sorted(by)
    for n, i in enumerate(keys):
        rows = []
        for j in keys[n // 2 * 2: n // 2 * 2 + 2]:
            vals = [v for v in by[j] if v is not None]
            c = np.mean(np.abs(vals)) if vals else 0
            s = [None if v is None or not c else v / c for v in by[j]]
            rows += [(s[t], *[s[t - k] for k in lags]) for t in range(max(lags), len(s)) if None not in (s[t], *[s[t - k] for k in lags])]
        vals = [v for v in by[i] if v is not None]
        c = np.mean(np.abs(vals)) if vals else 0
        if not c:
            assert all(got[i, day(39 + k)] is None for k in range(1, 11))
            continue
        if i == 7:
            continue  # shares a batch with a series of zeros: too few rows to fit, below
        beta, m = lstsq(rows), np.mean(vals) / c
        path = [m if v is None else v / c for v in by[i]]
        for k in range(1, 11):
            path.append(float(beta @ [1, *[path[-q] for q in lags]]))
            assert got[i, day(39 + k)] == pytest.approx(path[-1] * c, rel=1e-6)
    assert len([k for k in got if k[0] == 7]) == 10


def test_ols_without_covariates_is_the_pooled_ar(spark, series):
    df = spark.createDataFrame(series, SCHEMA).select("id", "timestamp", "y")
    a = sorted(forecast_ols(df, None, None, COLS, batch_size=100, horizon=4).collect())
    assert a == sorted(forecast_ar(df, 4, COLS, batch_size=100).collect()) and len(a) == 16


def test_ridge_with_more_columns_than_days(spark):
    rng = np.random.default_rng(3)
    p, n = 60, 25
    x = rng.normal(size=(n + 5, p)) * rng.uniform(0.5, 20, p) + rng.uniform(-5, 5, p)
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 7] = 4.0  # never moves
    y = np.nan_to_num(x[:, 0]) - 2 * np.nan_to_num(x[:, 1]) + rng.normal(size=n + 5)
    names = [f"col {j}" for j in range(p)]
    rows = [("s", day(t), float(y[t]) if t % 6 else None, *[None if np.isnan(v) else float(v) for v in x[t]]) for t in range(n + 5)]
    schema = "id string, timestamp date, y double, " + ", ".join(f"`{c}` double" for c in names)
    df = spark.createDataFrame(rows, schema)
    ctx, fut = df.where(F.col("timestamp") < day(n)), df.where(F.col("timestamp") >= day(n)).drop("y")
    got = {r.timestamp: r for r in forecast_ridge(ctx, fut, None, COLS, screen=20, ridge=0.2).collect()}
    have = np.array([t % 6 != 0 for t in range(n)])
    mu, sd = np.nanmean(x[:n], 0), np.nanstd(x[:n], 0)
    z = np.nan_to_num((x - mu) / np.where(sd > 0, sd, 1))
    yc = y[:n][have] - y[:n][have].mean()
    c = z[:n][have].T @ yc
    pick = sorted((j for j in range(p) if sd[j] > 0), key=lambda j: (-abs(c[j]), names[j]))[:20]
    zz = z[:n][have][:, pick]
    beta = np.linalg.solve(zz.T @ zz + 0.2 * have.sum() * np.eye(20), c[pick])
    for t in range(n, n + 5):
        assert got[day(t)].predictions == pytest.approx(y[:n][have].mean() + z[t, pick] @ beta, rel=1e-8)
    resid = y[:n][have] - y[:n][have].mean() - zz @ beta
    assert got[day(n)].q10 - got[day(n)].predictions == pytest.approx(np.quantile(resid, 0.1), rel=1e-6)
    with pytest.raises(Exception, match="fewer than 9"):
        forecast_ridge(ctx, fut, None, COLS, horizon=9).collect()


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_intervals_cross_the_ranges(spark, partitions):
    rng = random.Random(partitions)
    rows = [("hot", day(k), float(k)) for k in rng.sample(range(400), 200)] + [(f"s{i}", day(rng.randrange(400)), 1.0) for i in range(30)]
    rows += [("hot", None, 1.0), (None, day(1), 1.0), ("none", day(5), None)]
    df = spark.createDataFrame(rows, "series string, d date, v double")
    got = {(r.series, r._from): r._until for r in validity_intervals(df, ["series"], "d", "v", partitions=partitions).collect()}
    want = {}
    for s in {r[0] for r in rows if r[0]}:
        ds = sorted({r[1] for r in rows if r[0] == s and r[1]})
        want |= {(s, a): b for a, b in zip(ds, [*ds[1:], None])}
    assert got == want
    left = spark.createDataFrame([(s, day(k)) for s in ("hot", "s1", "none", "unknown") for k in range(-3, 410, 9)], "series string, t date")
    joined = asof_join(left, df, ["series"], "t", "d", "v", days=16, partitions=partitions).collect()
    assert len(joined) == left.count()
    for r in joined:
        seen = sorted((d, v) for s, d, v in rows if s == r.series and d is not None and d <= r.t)
        assert r.v == (seen[-1][1] if seen else None)


def test_asof_needs_no_nested_loop(spark):
    left = spark.range(50).selectExpr("'one' series", "date_add(date'2024-01-01', cast(id as int)) t")
    obs = spark.createDataFrame([("one", day(3), 1.0), ("one", day(30), 2.0)], "series string, d date, v double")
    out = asof_join(left, obs, ["series"], "t", "d", "v")
    assert out.where("v = 2").count() == 20 and "NestedLoop" not in plan(out)


def test_ordered_sink_reads_back_by_file_name(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(1000), f"k{rng.randrange(9)}") for _ in range(3000)]
    path = scratch_path(spark, "ordered").removeprefix("file:")
    write_ordered(spark.createDataFrame(rows, "n long, k string").repartition(6), path, ["n", "k"], fmt="csv", partitions=5)
    lines = []
    files = sorted(glob.glob(path + "/part-*"))
    for f in files:
        with open(f) as h:
            lines += [tuple(x.split(",")) for x in h.read().split("\n")[1:] if x]
    assert len(files) == 5 and [(int(a), b) for a, b in lines] == sorted(rows)
    back = with_input_order(read_csv(spark, path, schema="n long, k string"))
    assert [(r.n, r.k) for r in back.orderBy("ord").collect()] == sorted(rows)
    agg = panel.first_valid_long(back, ["k"], ["n"], "ord")
    assert "SortAggregate" not in plan(agg)
    assert {r.k: r.n for r in agg.collect()} == {k: min(n for n, j in rows if j == k) for k in {j for _, j in rows}}


def test_labels_by_dictionary(spark):
    rows = [(1, "A", day(1), 5), (1, "B", day(2), 1), (1, None, day(3), 1), (2, None, day(1), 1), (3, " ", day(1), 1),
            (4, "Z", day(1), 7), (4, "Y", day(1), 7), (4, "X", day(1), 6), (None, "Q", day(1), 1)]
    df = spark.createDataFrame(rows, "e long, label string, t date, ord long")
    out = panel.last_label(df, "e", "label", panel.time_order(df, "t", "ord"))
    assert {r.e: r.label for r in out.collect()} == {1: "B", 2: "unknown", 3: "unknown", 4: "Y"}
    assert "SortAggregate" not in plan(out)


def test_blocks_are_the_wide_panel(spark):
    rng = random.Random(6)
    rows = [(e, f"T{e % 5}", day(rng.randrange(9)), o, rng.random() if rng.random() < 0.8 else None, float(o)) for o, e in
            enumerate(rng.choice(range(11)) for _ in range(200))]
    df = spark.createDataFrame(rows, "e long, label string, t date, ord long, p double, v double")
    wide = panel.widen(df, "e", "t", ["p", "v"], "ord", "label")
    manifest, blocks = panel.wide_blocks(df, "e", "t", ["p", "v"], "ord", "label", per_block=4)
    names = [r.column_name for r in manifest.orderBy("block", "position").collect()]
    assert names == wide.columns[2:]
    want = {r["t"]: r for r in wide.collect()}
    for b in range(3):
        part = panel.wide_block(blocks, manifest, b, "t", ["p", "v"])
        assert part.columns == ["id", "t", *names[8 * b: 8 * b + 8]]
        got = part.collect()
        assert len(got) == len(want) and all(r[c] == want[r["t"]][c] for r in got for c in part.columns)
    with pytest.raises(ValueError):
        panel.wide_blocks(df, "e", "t", ["p"], "ord", "label", prefix_entity=False)


def test_row_groups_keep_to_the_budget(spark):
    rng = random.Random(8)
    sizes = {k: rng.randint(1, 40) for k in range(50)} | {99: 500}
    df = spark.createDataFrame([(k,) for k, n in sizes.items() for _ in range(n)], "k long")
    got = {r.k: r.group for r in row_groups(df, "k", 100, partitions=5).collect()}
    at, want = 0, {}
    for k in sorted(sizes):
        want[k] = at // 100
        at += sizes[k]
    assert got == want


def test_closures_of_the_user(spark):
    rows = [("financialHolidaysNYSE", dt.date(2001, 3, 1), "Flood", "notice 7", None), ("financialHolidaysNYSE", dt.date(2001, 7, 4), "Again", "notice 8", None),
            ("financialHolidaysNYSE", dt.date(2001, 3, 2), "Withdrawn", "notice 9", dt.date(2001, 3, 1)), ("other", dt.date(2001, 3, 5), "X", "y", None),
            ("financialHolidaysNYSE", dt.date(2005, 1, 1), "Outside", "z", None)]
    own = spark.createDataFrame(rows, "cal string, date date, name string, source string, valid_to date")
    got = {r.timestamp: r.financialHolidaysNYSE for r in holiday_calendar("2001-01-01", "2001-12-31", spark=spark, closures=own).collect()}
    plain = {r.timestamp: r.financialHolidaysNYSE for r in holiday_calendar("2001-01-01", "2001-12-31", spark=spark).collect()}
    assert got == plain | {dt.date(2001, 3, 1): "Flood", dt.date(2001, 7, 4): "Independence Day; Again"}
    with pytest.raises(Exception, match="without a source"):
        holiday_calendar("2001-01-01", "2001-12-31", spark=spark, closures=own.withColumn("source", F.lit(" "))).collect()


@pytest.mark.parametrize("few_cells,broadcast", [(False, True), (True, True), (True, False)])
def test_ridge_without_a_screen_fits_all_columns(spark, monkeypatch, few_cells, broadcast):
    """Every moving column counts, with more columns than days and with fewer, in one block and in many."""
    if few_cells:
        monkeypatch.setattr(regress, "BLOCK_CELLS", 40)
        monkeypatch.setattr(regress, "PIECE", 7)
    if not broadcast:
        monkeypatch.setattr(regress, "BROADCAST_ROWS", 0)
    rng = np.random.default_rng(11)
    shapes = {"wide": (90, 24), "tall": (5, 40)}
    data, rows, cells = {}, [], []
    for s, (p, n) in shapes.items():
        x = rng.normal(size=(n + 4, p)) * rng.uniform(0.5, 20, p) + rng.uniform(-5, 5, p)
        x[rng.random(x.shape) < 0.3] = np.nan
        x[:, 2] = 4.0  # never moves
        y = np.nan_to_num(x) @ rng.normal(size=p) + rng.normal(size=n + 4)
        data[s] = x, y
        rows += [(s, day(t), float(y[t]) if t % 6 else None) for t in range(n + 4)]
        cells += [(s, day(t), f"c{j}", float(x[t, j])) for t in range(n + 4) for j in range(p) if not np.isnan(x[t, j])]
    rows += [(None, day(0), 1.0), ("bare", day(0), 1.0), ("bare", day(30), None)]
    df = spark.createDataFrame(rows, "id string, timestamp date, y double")
    cells = spark.createDataFrame(cells, "id string, timestamp date, column string, value double")
    ends = F.create_map(*[F.lit(v) for s, (_, n) in shapes.items() for v in (s, day(n))])
    end = F.coalesce(ends[F.col("id")], F.lit(day(24)))
    ctx, fut = df.where(F.col("timestamp") < end), df.where(F.col("timestamp") >= end).drop("y")
    got = {(r.id, r.timestamp): r for r in forecast_ridge(ctx, fut, None, COLS, ridge=0.2, cells=cells).collect()}
    assert len(got) == 9 and got["bare", day(30)].predictions is None
    for s, (p, n) in shapes.items():
        x, y = data[s]
        have = np.array([t % 6 != 0 for t in range(n)])
        mu, sd = np.nanmean(x[:n], 0), np.nanstd(x[:n], 0)
        z = np.nan_to_num((x - mu) / np.where(sd > 0, sd, 1))[:, sd > 0]
        zz, my = z[:n][have], y[:n][have].mean()
        beta = np.linalg.solve(zz.T @ zz + 0.2 * have.sum() * np.eye(zz.shape[1]), zz.T @ (y[:n][have] - my))
        low = np.quantile((y[:n] - my - z[:n] @ beta)[have], 0.1)
        for t in range(n, n + 4):
            want = my + z[t] @ beta
            assert got[s, day(t)].predictions == pytest.approx(want, rel=1e-8) and got[s, day(t)].q10 == pytest.approx(want + low, rel=1e-8)


def test_score_panel_covariates_fits_every_covariate():
    from panelforge.plans import queries
    assert {v.method: v.screen for v in queries.WHOLE_VARIANTS} == {"mean": None, "ridge": None}
