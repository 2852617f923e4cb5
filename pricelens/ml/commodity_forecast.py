"""Commodity-level recursive forecaster (M14, M6): daily mean price per
commodity, lags 1/2/3/7/14/30, trailing means of the previous 7 and 30 days,
calendar parts; one boosted model per commodity, all fitted in the same jobs,
evaluated on the last 20 % of rows of every commodity (W13), then a recursive
30-day forecast per commodity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions import is_weekend, weekday0
from pricelens.ml.forecast import recursive_forecast
from pricelens.ml.grouped_trees import TreeModel, TreeSpec, fit_trees
from pricelens.operators.windows import lag, rolling, row_rank_split, spec

LAGS = (1, 2, 3, 7, 14, 30)
FEATURES = [f"lag_{k}" for k in LAGS] + ["rolling_7", "rolling_30", "month", "day", "day_of_week", "quarter", "year", "weekend_int"]
#: The settings of a commodity's model.
PER_COMMODITY = TreeSpec(kind="boost", trees=500, depth=6, step=0.03, min_leaf=3, subsample=0.8, features=0.8, l2=1.0)


def commodity_daily(panel: DataFrame) -> DataFrame:
    return panel.groupBy("commodity", "date").agg(F.avg("modal_price").alias("modal_price"))


def commodity_features(daily: DataFrame) -> DataFrame:
    w = spec("commodity", "date")
    d = F.col("date")
    cols = [lag("modal_price", k, w).alias(f"lag_{k}") for k in LAGS]
    cols += [rolling("mean", "modal_price", 7, w, False).alias("rolling_7"),
             rolling("mean", "modal_price", 30, w, False).alias("rolling_30")]
    f = daily.select("*", *cols).withColumns({
        "month": F.month(d), "day": F.dayofmonth(d), "day_of_week": weekday0(d), "quarter": F.quarter(d),
        "year": F.year(d), "weekend_int": is_weekend(d).cast("int")})
    return f.na.drop(subset=FEATURES)


def fit_and_forecast(panel: DataFrame, horizon: int = 30, spec_: TreeSpec = PER_COMMODITY) -> tuple[TreeModel, DataFrame, DataFrame]:
    """(model, test predictions, forecast)."""
    daily = commodity_daily(panel)
    feats = commodity_features(daily)
    split = row_rank_split(feats, ["commodity"], "date", 0.8)
    model = fit_trees(split.filter("is_train"), FEATURES, "modal_price", ["commodity", "date"], spec_, key="commodity")
    test_pred = model.transform(split.filter("NOT is_train")).filter(F.col("prediction").isNotNull())
    return model, test_pred, recursive_forecast(model, daily, horizon=horizon, keys=("commodity",), lags=LAGS)
