"""Property tests: window features and guarded correlation against pandas/numpy."""

import datetime as dt
import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pricelens.functions import safe_corr
from pricelens.operators import windows as W

values = st.lists(st.one_of(st.none(), st.floats(min_value=-1e4, max_value=1e4, allow_nan=False)),
                  min_size=1, max_size=45)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=values, n=st.integers(min_value=1, max_value=10), m=st.integers(min_value=1, max_value=10),
       include=st.booleans())
def test_rolling_mean_matches_pandas(spark, vals, n, m, include):
    m = min(m, n)
    base = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("k", "d", base + dt.timedelta(i), v) for i, v in enumerate(vals)],
                               "commodity string, district string, date date, modal_price double")
    w = W.spec(["commodity", "district"], "date")
    got = df.select("date", W.rolling("mean", "modal_price", n, w, include, m).alias("r")).orderBy("date").toPandas()["r"]
    s = pd.Series([np.nan if v is None else v for v in vals], dtype="float64")
    exp = (s if include else s.shift(1)).rolling(n, min_periods=m).mean()
    assert np.allclose(got.to_numpy(dtype="float64"), exp.to_numpy(), equal_nan=True, rtol=1e-9, atol=1e-6)


pairs = st.lists(st.tuples(st.one_of(st.none(), st.floats(-100, 100, allow_nan=False)),
                           st.one_of(st.none(), st.floats(-100, 100, allow_nan=False))), min_size=0, max_size=30)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=pairs)
def test_safe_corr_matches_pairwise_pandas(spark, rows):
    df = spark.createDataFrame(rows, "x double, y double") if rows else spark.createDataFrame([], "x double, y double")
    got = df.agg(safe_corr("x", "y").alias("c")).first().c
    p = pd.DataFrame(rows, columns=["x", "y"], dtype="float64").dropna()
    sx, sy = p.x.std(), p.y.std()
    if len(p) < 2 or not (sx > 0 and sy > 0) or not math.isfinite(sx * sy) or sx * sy == 0:
        assert got is None or abs(got) <= 1 + 1e-9
        if len(p) < 2:
            assert got is None
        return
    exp = p.x.corr(p.y)
    assert got is not None and abs(got - exp) <= 1e-6
