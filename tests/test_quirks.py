"""Golden micro-frames, one per quirk of the reference."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelforge.functions.aggs import metric_columns
from panelforge.operators import clean, panel
from panelforge.operators.score import score

D = dt.date


def test_first_valid_merges_fields_from_different_rows(spark):
    df = spark.createDataFrame(
        [(1, D(2024, 1, 2), None, 10.0, 1), (1, D(2024, 1, 2), 0.5, 20.0, 2),
         (1, D(2024, 1, 2), 0.7, None, 3)], "permco long, timestamp date, dlyret double, dlyvol double, ord long")
    row = panel.first_valid_long(df, ["permco", "timestamp"], ["dlyret", "dlyvol"], "ord").first()
    assert row["dlyret"] == 0.5 and row["dlyvol"] == 10.0


def test_first_valid_is_invariant_to_input_partitioning(spark):
    rows = [(k % 5, D(2024, 1, 1 + k % 3), (None if k % 4 == 0 else float(k)), k) for k in range(200)]
    df = spark.createDataFrame(rows, "permco long, timestamp date, v double, ord long")
    a = sorted(panel.first_valid_long(df, ["permco", "timestamp"], ["v"], "ord").collect())
    b = sorted(panel.first_valid_long(df.repartition(7).sortWithinPartitions(F.rand(3)),
                                      ["permco", "timestamp"], ["v"], "ord").collect())
    assert a == b


def test_last_label_skips_null_and_blank_becomes_unknown(spark):
    df = spark.createDataFrame(
        [(1, "AAA", 1), (1, None, 2), (2, "  ", 1), (3, None, 1), (None, "ZZZ", 9)],
        "permco long, ticker string, ord long")
    out = {r["permco"]: r["label"] for r in panel.last_label(df, "permco", "ticker", "ord").collect()}
    assert out == {1: "AAA", 2: "unknown", 3: "unknown"}


def test_label_collision_uses_entity_prefix():
    names, prefixed = panel.wide_names([("10", "MSFT"), ("11", "MSFT")], ["dlyret"])
    assert prefixed and names == ["10_MSFT_dlyret", "11_MSFT_dlyret"]
    names, prefixed = panel.wide_names([("10", "MSFT"), ("11", "AAPL")], ["dlyret"])
    assert not prefixed and names == ["MSFT_dlyret", "AAPL_dlyret"]
    with pytest.raises(ValueError):
        panel.wide_names([("10", "X"), ("11", "X")], ["f"], prefix_entity=False)


def test_wide_calendar_bounds_and_inner_gaps(spark):
    rows = [
        (1, "2024-01-01", None, None, "AAA", 1),   # all-null edge date: outside the bounds
        (1, "2024-01-02", 1.0, 5.0, "AAA", 2),
        (2, "2024-01-03", None, None, "BBB", 3),   # all-null inner date: kept with nulls
        (2, "2024-01-05", 2.0, None, "BBB", 4),
        (None, "2024-01-09", 9.0, 9.0, "N", 5),    # null key: ignored
    ]
    df = spark.createDataFrame(rows, "permco long, timestamp string, dlyret double, dlyvol double, "
                                     "ticker string, ord long")
    df = clean.parse_time(df)
    wide = panel.widen(df, "permco", "timestamp", ["dlyret", "dlyvol"], "ord", "ticker")
    got = wide.orderBy("timestamp").collect()
    assert [r["timestamp"] for r in got] == [D(2024, 1, 2), D(2024, 1, 3), D(2024, 1, 4), D(2024, 1, 5)]
    assert wide.columns == ["id", "timestamp", "AAA_dlyret", "AAA_dlyvol", "BBB_dlyret", "BBB_dlyvol"]
    assert got[0]["AAA_dlyret"] == 1.0 and got[1]["AAA_dlyret"] is None
    assert got[3]["BBB_dlyret"] == 2.0 and got[3]["BBB_dlyvol"] is None


def test_bad_timestamps_are_counted_and_raise(spark):
    df = spark.createDataFrame([(1, "2024-01-02"), (1, "junk"), (2, "2024-01-02"), (2, "2024-01-02")],
                               "permco long, dlycaldt string")
    c = clean.check_counts(df, ["permco", "dlycaldt"], raw_time_col="dlycaldt").first()
    assert c["n_bad_timestamps"] == 1 and c["n_duplicate_keys"] == 1 and c["n_rows"] == 4
    with pytest.raises(ValueError, match="1 of 4 rows have no readable date"):
        clean.validate_panel(df, ["permco", "dlycaldt"], raw_time_col="dlycaldt")
    with pytest.raises(Exception, match="invalid timestamp"):
        clean.parse_time(df.withColumnRenamed("dlycaldt", "timestamp"), on_error="raise").collect()


def test_headers_and_required_columns(spark):
    df = spark.createDataFrame([(1, 2)], "` Ticker ` long, `PERMCO` long")
    assert clean.normalise_headers(df).columns == ["ticker", "permco"]
    with pytest.raises(KeyError, match="dlycaldt"):
        clean.require_columns(clean.normalise_headers(df), ["ticker", "dlycaldt"])


def _metrics(spark, y, p, policy):
    df = spark.createDataFrame(list(zip(y, p)), "y double, p double")
    return df.agg(*metric_columns("y", "p", policy)).first()


def test_metric_null_policies(spark):
    prop = _metrics(spark, [1.0, None, 2.0], [1.0, 1.0, 1.0], "propagate")
    assert prop["MSE"] is None and prop["R2"] is None and prop["n"] == 3
    assert prop["MAPE"] == pytest.approx(25.0)
    skip = _metrics(spark, [1.0, None, 2.0], [1.0, 1.0, 1.0], "skip")
    assert skip["MSE"] == pytest.approx(0.5) and skip["n_valid"] == 2
    assert skip["RMSE"] ** 2 == pytest.approx(skip["MSE"])


def test_constant_truth_r2_null_and_zero_truth_skipped_in_mape(spark):
    m = _metrics(spark, [3.0, 3.0, 3.0], [1.0, 2.0, 3.0], "propagate")
    assert m["R2"] is None
    z = _metrics(spark, [0.0, 2.0], [1.0, 1.0], "propagate")
    assert z["MAPE"] == pytest.approx(50.0)


def test_r2_can_be_negative_and_is_not_regr_r2(spark):
    m = _metrics(spark, [1.0, 2.0, 3.0], [3.0, 2.0, 1.0], "propagate")
    assert m["R2"] == pytest.approx(1 - 8 / 2)


def test_split_edges_inclusive(spark):
    df = spark.createDataFrame([(D(2000, 1, 1),), (D(2000, 12, 31),), (D(2001, 1, 1),), (D(1999, 12, 31),)],
                               "timestamp date")
    w = {"validation": ("2000-01-01", "2000-12-31"), "test": ("2001-01-01", "2001-12-31")}
    tagged = {(r["timestamp"], r["split"]) for r in panel.split_windows(df, w).collect()}
    assert (D(2000, 1, 1), "validation") in tagged and (D(2000, 12, 31), "validation") in tagged
    assert (D(2001, 1, 1), "test") in tagged and (D(2001, 1, 1), "all") in tagged
    assert not any(t == D(1999, 12, 31) for t, _ in tagged)


def test_score_inner_join_drops_unmatched(spark):
    pred = spark.createDataFrame([(1, D(2024, 1, 1), "y", 1.0, "m"), (1, D(2024, 1, 9), "y", 5.0, "m")],
                                 "id long, timestamp date, target_name string, predictions double, model string")
    truth = spark.createDataFrame([(1, D(2024, 1, 1), 2.0)], "id long, timestamp date, y double")
    r = score(pred, truth).first()
    assert r["n"] == 1 and r["MSE"] == pytest.approx(1.0)


def test_scalar_helpers(spark):
    from panelforge.functions.aggs import adjusted_r2
    from panelforge.functions.exprs import concat_name, format_entity, format_ticker
    df = spark.createDataFrame([(17.0, " MSFT ", 0.5, 10), (17.5, None, 0.5, 3)],
                               "p double, t string, r2 double, n long")
    rows = df.select(format_entity("p").alias("e"), format_ticker("t").alias("t"),
                     concat_name(format_entity("p"), format_ticker("t"), F.lit("dlyret")).alias("c"),
                     adjusted_r2("r2", "n", 2).alias("a")).collect()
    assert rows[0]["e"] == "17" and rows[0]["t"] == "MSFT" and rows[0]["c"] == "17_MSFT_dlyret"
    assert rows[0]["a"] == pytest.approx(1 - 0.5 * 9 / 7)
    assert rows[1]["e"] == "17.5" and rows[1]["t"] == "unknown" and rows[1]["a"] is None


def test_order_key_is_fixed_width_and_keeps_nulls(spark):
    from panelforge.functions.aggs import first_valid
    from panelforge.functions.exprs import pack_order_key
    key = pack_order_key([("a", 12), ("b", 10)])
    for rows in ([(1, 2), (1, 3), (2, 0)], [(2 ** 39, 2 ** 30), (2 ** 39, 2 ** 30 + 1), (2 ** 39 + 1, 0)]):
        df = spark.createDataFrame(rows, "a long, b long").select("a", "b", key.alias("k"))
        assert dict(df.dtypes)["k"] == "decimal(38,0)"
        assert [(r["a"], r["b"]) for r in df.orderBy("k").collect()] == sorted(rows)
    part_null = spark.createDataFrame([(1, None, 7.0), (2, 1, 8.0)], "a long, b long, v double")
    assert part_null.withColumn("ord", key).groupBy().agg(first_valid("v", "ord").alias("v")).first()["v"] == 7.0
    with pytest.raises(Exception, match="order key part"):
        spark.createDataFrame([(-1, 1)], "a long, b long").select(key).collect()

