"""Recursive multi-day forecast for every series in one pass.

State: one row per key with the frozen covariates of its latest row and the
last 30 prices.  The fitted trees are a table of one packed row per tree; each
chunk of series meets the trees of its model once, and its task takes all steps
over the price arrays: the features of the next day come from the array and the
date, the *unrounded* prediction joins the history, the rounded one is reported
(X20).  One job, whatever the horizon; a lost executor costs its chunks.  A model
that is too large to be held for all steps is read once for each step, in a job a
day, with the same values.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions import is_weekend, weekday0
from pricelens.ml.grouped_trees import TreeModel, _scored, features_matrix, replace_frames
from pricelens.session import checkpoint_dir, ship_package

HISTORY = 30
HORIZON = 30
#: Series whose steps a task takes at once, and bytes of trees that it may hold.
SERIES = 2_000
MODEL_BYTES = 128_000_000


def _mean_last(arr, n: int):
    s = F.slice(arr, -n, n)
    return F.aggregate(s, F.lit(0.0), lambda acc, x: acc + x) / F.size(s)


def initial_state(panel: DataFrame, keys=("commodity", "district"), min_history: int = HISTORY) -> DataFrame:
    """Latest row per key + last ``HISTORY`` prices; keys with fewer rows are skipped.

    Only the last ``HISTORY`` rows of each key are kept (a rank-limited window,
    planned as a per-group limit), then one aggregate per key builds the
    ordered price array and picks the latest row's covariates.
    """
    keys = list(keys)
    if HISTORY < min_history:
        raise ValueError("history array shorter than the required history")
    last = Window.partitionBy(*keys).orderBy(F.desc("date"))
    n = panel.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_history)
    tail = panel.withColumn("_rn", F.row_number().over(last)).filter(F.col("_rn") <= HISTORY)
    others = [c for c in panel.columns if c not in keys]
    agg = tail.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("date", "modal_price"))),
                    lambda x: x["modal_price"]).alias("hist"),
        F.max_by(F.struct(*others), "date").alias("_latest"))
    return agg.join(n.select(*keys), keys).select(*keys, "_latest.*", "hist")


def step_features(state: DataFrame, lags=(1, 2, 3)) -> DataFrame:
    """Features of the next day from the history array and the next date."""
    d = F.date_add("date", 1)
    cols = {"date": d, "year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d),
            "day_of_week": weekday0(d), "quarter": F.quarter(d), "weekend_int": is_weekend(d).cast("int"),
            "rolling_7": _mean_last(F.col("hist"), 7), "rolling_30": _mean_last(F.col("hist"), 30)}
    cols.update({f"lag_{k}": F.element_at("hist", -k) for k in lags})
    return state.withColumns(cols)


def _day_features(days: np.ndarray, hist: np.ndarray, lags) -> dict[str, np.ndarray]:
    """The same for many series at once: days since 1970 and [series, HISTORY] prices."""
    at = pd.DatetimeIndex(days.astype("datetime64[D]"))
    out = {"year": at.year, "month": at.month, "day": at.day, "day_of_week": at.dayofweek, "quarter": at.quarter, "weekend_int": at.dayofweek >= 5}
    out |= {f"rolling_{k}": np.cumsum(hist[:, -k:], axis=1)[:, -1] / k for k in (7, 30)}
    return out | {f"lag_{k}": hist[:, -k] for k in lags}


def _by_days(model: TreeModel, state: DataFrame, horizon: int, keys: list[str], lags) -> DataFrame:
    """date, <keys>, predicted_raw: a job a day, whose tasks read the trees batch by batch; each day's state is stored."""
    spark, columns, inf = state.sparkSession, state.columns, F.lit(float("inf"))
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pricelens_trees/forecast-{uuid.uuid4().hex}"
    past = [c for c in ("rolling_7", "rolling_30", *(f"lag_{k}" for k in lags)) if c in model.features]
    out = None
    for day in range(horizon):
        # a missing price goes right in every node, as in the steps of one task
        now = step_features(state, lags).withColumns({c: F.nanvl(F.coalesce(c, inf), inf) for c in past})
        now = model.transform(now).filter(F.col("prediction").isNotNull())
        now = now.withColumn("hist", F.slice(F.concat("hist", F.array(F.greatest("prediction", F.lit(0.0)))), -HISTORY, HISTORY)).select(*columns)
        now.write.parquet(f"{folder}/day-{day}")
        state = spark.read.schema(now.schema).parquet(f"{folder}/day-{day}")
        step = state.select("date", *(F.col(k).cast("string").alias(k) for k in keys), F.element_at("hist", -1).alias("predicted_raw"))
        out = step if out is None else out.unionByName(step)
    return out


def _in_one_task(model: TreeModel, state: DataFrame, horizon: int, keys: list[str], lags) -> DataFrame:
    """The same: a task holds the trees and takes all steps of its series."""
    state = model.encoded(step_features(state, lags))
    features, width, own = model.features, model.width, replace_frames(model)
    out_schema = pa.schema([("date", pa.date32()), *((k, pa.string()) for k in keys), ("predicted_raw", pa.float64())])

    def steps(t: pa.Table, trees: Iterator[tuple]) -> pa.Table:
        nodes, x = list(trees), features_matrix(t, features)
        if not nodes:
            return out_schema.empty_table()
        hist = np.array(t.column("hist").to_pylist(), float)
        day = t.column("date").cast(pa.int32()).to_numpy().astype(np.int64)
        days, prices = [], []
        for h in range(horizon):
            for name, v in _day_features(day + h, hist, lags).items():
                if name in features:
                    x[:, features.index(name)] = v
            p = np.maximum(own.combine(*_scored(x, nodes, width))[:, 0], 0.0)
            hist = np.concatenate([hist[:, 1:], p[:, None]], axis=1)
            days.append(day + h)
            prices.append(p)
        names = [pa.array(t.column(c).to_pylist() * horizon, pa.string()) for c in keys]
        return pa.table([pa.array(np.concatenate(days).astype(np.int32), pa.int32()).cast(pa.date32()), *names, np.concatenate(prices)], schema=out_schema)

    needed = dict.fromkeys([*features, *([model.key] if model.key else [])])
    state = state.select(*(F.col(k).cast("string").alias(k) for k in keys), *(c for c in needed if c not in keys), "date", "hist")
    ddl = "date date, " + ", ".join(f"{k} string" for k in keys) + ", predicted_raw double"
    return model.meet(state, SERIES, keys, steps, ddl)


def recursive_forecast(model: TreeModel, panel: DataFrame, horizon: int = HORIZON,
                       keys=("commodity", "district"), lags=(1, 2, 3)) -> DataFrame:
    """Output: date, <keys>, predicted_price (rounded 2), predicted_raw.  A key without a model has no forecast."""
    ship_package(panel.sparkSession)
    keys = list(keys)
    most = model.packed.groupBy("key").agg(F.sum(F.octet_length("ids") * 4).alias("b")).agg(F.max("b")).first()[0] or 0
    take = _by_days if most > MODEL_BYTES else _in_one_task
    raw = take(model, initial_state(panel, keys), horizon, keys, lags)
    return raw.select("date", *keys, F.bround("predicted_raw", 2).alias("predicted_price"), "predicted_raw")
