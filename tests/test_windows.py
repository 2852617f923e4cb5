import datetime as dt

import numpy as np
import pandas as pd

from pricelens.operators import windows as W


def _series(spark, values, key="a"):
    base = dt.date(2024, 1, 1)
    data = [(key, "d1", base + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "commodity string, district string, date date, modal_price double")


def test_lag_and_rolling_match_pandas(spark):
    vals = [float(v) for v in np.random.RandomState(0).uniform(10, 20, 40)]
    vals[12] = None
    df = _series(spark, vals)
    out = W.add_history_features(df, lags=(1, 2), windows=(7,), include_current=False).orderBy("date").toPandas()
    s = pd.Series(vals, dtype="float64")
    exp_roll = s.shift(1).rolling(7).mean()
    exp_roll_min1 = s.shift(1).rolling(7, min_periods=1).mean()
    pd.testing.assert_series_equal(out["lag_1"], s.shift(1), check_names=False)
    pd.testing.assert_series_equal(out["rolling_7"], exp_roll, check_names=False)
    out2 = W.add_history_features(df, lags=(), windows=(7,), include_current=False,
                                  min_periods=1).orderBy("date").toPandas()
    pd.testing.assert_series_equal(out2["rolling_7"], exp_roll_min1, check_names=False)


def test_rolling_include_current_min5_mean_std(spark):
    vals = [1.0, 2.0, 4.0, 7.0, 11.0, 16.0, 22.0, 29.0]
    df = _series(spark, vals)
    out = W.add_rolling_zscore(df, "modal_price", n=4, min_periods=3, name="p").orderBy("date").toPandas()
    s = pd.Series(vals)
    pd.testing.assert_series_equal(out["p_rolling_mean"], s.rolling(4, min_periods=3).mean(), check_names=False)
    pd.testing.assert_series_equal(out["p_rolling_std"], s.rolling(4, min_periods=3).std(), check_names=False)


def test_constant_series_zscore_null(spark):
    df = _series(spark, [5.0] * 10)
    out = W.add_rolling_zscore(df, "modal_price", n=30, min_periods=5, name="p").toPandas()
    assert out["p_zscore"].isna().all()
    out0 = W.add_rolling_zscore(df, "modal_price", n=30, min_periods=5, name="p", zero_std_as_zero=True).toPandas()
    assert (out0["p_zscore"] == 0).all()  # fillna(0) covers short and constant windows alike


def test_fill_within_keys_never_crosses_keys(spark):
    base = dt.date(2024, 1, 1)
    data = [("a", "d", base, None), ("a", "d", base + dt.timedelta(1), 3.0), ("a", "d", base + dt.timedelta(2), None),
            ("b", "d", base, None), ("b", "d", base + dt.timedelta(1), None)]
    df = spark.createDataFrame(data, "commodity string, district string, date date, x double")
    out = W.fill_within_keys(df, ["x"]).orderBy("commodity", "date").toPandas()
    assert list(out["x"][:3]) == [3.0, 3.0, 3.0]
    assert out["x"][3:].isna().all()


def test_first_last_n_and_short_group(spark):
    df = _series(spark, [1.0, 2.0, 3.0, 4.0, 5.0]).unionByName(_series(spark, [7.0], key="b"))
    out = {r.commodity: r for r in W.first_last_n_mean(df, "modal_price", ["commodity"], "date", 3).collect()}
    assert out["a"].first_mean == 2.0 and out["a"].last_mean == 4.0
    assert out["b"].first_mean == 7.0 == out["b"].last_mean


def test_repartition_does_not_change_features(spark):
    vals = [float(v) for v in np.random.RandomState(1).uniform(10, 20, 60)]
    df = _series(spark, vals).unionByName(_series(spark, vals[::-1], key="b"))
    a = W.add_history_features(df).orderBy("commodity", "date").toPandas()
    b = W.add_history_features(df.repartition(7).sortWithinPartitions("modal_price")).orderBy("commodity", "date").toPandas()
    pd.testing.assert_frame_equal(a, b)


def test_blocked_windows_equal_plain_windows(spark):
    rng = np.random.RandomState(5)
    base = dt.date(2024, 1, 1)
    rows = []
    for key in ["a", "b", "c"]:
        days = sorted(rng.choice(400, 150, replace=False))  # gaps: some 7-day blocks hold 0-2 rows
        rows += [(key, "d", base + dt.timedelta(int(x)), float(rng.uniform(1, 9))) for x in days]
    df = spark.createDataFrame(rows, "commodity string, district string, date date, modal_price double")
    plain = W.add_history_features(df, lags=(1, 2, 3), windows=(7, 30)).orderBy("commodity", "date").toPandas()
    for bd in (7, 45):
        blk = W.blocked_history_features(df, lags=(1, 2, 3), windows=(7, 30), block_days=bd)
        got = blk.orderBy("commodity", "date").toPandas()[plain.columns]
        pd.testing.assert_frame_equal(plain, got)


def test_top1_per_group_and_row_rank_split(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("a", "x", 5.0), ("a", "y", 7.0), ("a", "z", 7.0), ("b", "x", 1.0)],
                               "commodity string, district string, v double")
    top = {r.commodity: r.district for r in
           W.top1_per_group(df, "commodity", [F.col("v").desc(), F.col("district").asc()]).collect()}
    assert top == {"a": "y", "b": "x"}  # tie on 7.0 -> first district
    base = dt.date(2024, 1, 1)
    s = spark.createDataFrame([("a", base + dt.timedelta(i)) for i in range(10)], "commodity string, date date")
    r = W.row_rank_split(s, ["commodity"], "date", 0.8).orderBy("date").toPandas()
    assert r.is_train.tolist() == [True] * 8 + [False] * 2
