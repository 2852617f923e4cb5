import datetime as dt

import numpy as np

from pricelens.operators.asof import asof_features


def test_asof_matches_brute_force(spark):
    rng = np.random.RandomState(3)
    base = dt.date(2024, 1, 1)
    hist = []
    for key in ["a", "b"]:
        days = sorted(rng.choice(80, 50, replace=False))
        hist += [(key, "d", base + dt.timedelta(int(x)), float(rng.uniform(10, 20))) for x in days]
    req = [(k, "d", base + dt.timedelta(int(x))) for k in ["a", "b", "z"] for x in (0, 20, 45, 60, 79, 90)]
    h = spark.createDataFrame(hist, "commodity string, district string, date date, modal_price double")
    r = spark.createDataFrame(req, "commodity string, district string, date date")
    for bd in (None, 5, 30):
        got = {(x.commodity, x.date): x for x in asof_features(r, h, min_history=30, block_days=bd).collect()}
        _check(got, hist, req)


def _check(got, hist, req):
    for k, dd, day in req:
        prior = sorted((d, p) for c, _, d, p in hist if c == k and d < day)
        g = got[(k, day)]
        assert g.history_rows == len(prior)
        assert g.history_ok == (len(prior) >= 30)
        prices = [p for _, p in prior]
        if prices:
            assert g.lag_1 == prices[-1]
            if len(prices) >= 30:
                assert abs(g.rolling_30 - np.mean(prices[-30:])) < 1e-9
            else:
                assert g.rolling_30 is None
        else:
            assert g.lag_1 is None
