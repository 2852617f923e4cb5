"""Crisis, outlier and price-category scores.

Fixed values: stress thresholds, weights and level cut-offs below are the
reference scoring rules and must stay equal to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions import col, pct, pct_change
from pricelens.operators.windows import add_rolling_zscore, lag, spec

# Fixed values ---------------------------------------------------------------
PRICE_STRESS_CUTS = (30.0, 20.0, 10.0)          # abs % change -> 3, 2, 1
SUPPLY_STRESS_CUTS = (-50.0, -30.0, -15.0)      # arrival deviation % -> 3, 2, 1
HEAT_HIGH, HEAT_MID = 40.0, 35.0                # max temp: +2 / +1
RAIN_HIGH, RAIN_MID = 100.0, 50.0               # rainfall mm: +2 / +1
WIND_HIGH = 30.0                                # wind: +1
WEATHER_CAP = 3
ANOMALY_Z = 2.0                                 # abs z >= 2 -> stress 3
CRISIS_WEIGHTS = (0.35, 0.30, 0.20, 0.15)       # price, supply, weather, anomaly
CRISIS_LEVELS = ((80.0, "Critical"), (60.0, "High"), (30.0, "Moderate"))
CRISIS_LEVEL_ORDER = ("Low", "Moderate", "High", "Critical")
ROLL_N, ROLL_MIN = 30, 5


def price_stress(abs_pct) -> Column:
    a = col(abs_pct)
    c3, c2, c1 = PRICE_STRESS_CUTS
    return (F.when(a >= c3, 3).when(a >= c2, 2).when(a >= c1, 1).otherwise(0))


def supply_stress(dev_pct) -> Column:
    d = col(dev_pct)
    c3, c2, c1 = SUPPLY_STRESS_CUTS
    return (F.when(d <= c3, 3).when(d <= c2, 2).when(d <= c1, 1).otherwise(0))


def weather_stress(max_temp, rainfall, wind) -> Column:
    t, r, w = col(max_temp), col(rainfall), col(wind)
    s = (F.when(t >= HEAT_HIGH, 2).when(t >= HEAT_MID, 1).otherwise(0)
         + F.when(r >= RAIN_HIGH, 2).when(r >= RAIN_MID, 1).otherwise(0)
         + F.when(w >= WIND_HIGH, 1).otherwise(0))
    return F.least(s, F.lit(WEATHER_CAP))


def crisis_score(p, s, w, a) -> Column:
    wp, ws, ww, wa = CRISIS_WEIGHTS
    raw = ((col(p) * F.lit(wp) + col(s) * F.lit(ws) + col(w) * F.lit(ww) + col(a) * F.lit(wa))
           / F.lit(3.0) * F.lit(100.0))
    return F.least(F.greatest(raw, F.lit(0.0)), F.lit(100.0))


def crisis_level(score) -> Column:
    s = col(score)
    out = None
    for cut, name in CRISIS_LEVELS:
        out = F.when(s >= cut, F.lit(name)) if out is None else out.when(s >= cut, F.lit(name))
    return out.otherwise(F.lit("Low"))


CRISIS_REQUIRED = ["date", "commodity", "modal_price", "arrival", "price_change", "max_temp", "min_temp",
                   "rainfall_mm", "wind"]


WEATHER_COLUMNS = ["max_temp", "min_temp", "rainfall_mm", "wind"]


def crisis_input(panel_wx: DataFrame, keys=("commodity", "district"), order=("date",)) -> DataFrame:
    """Scoring input, following the feature stage and the engine's contract:
    weather gaps are back- then forward-filled within each series (P13, never
    across keys), the first difference of the price is taken over the full
    series, and rows still missing a required column are dropped (P7) before
    the crisis windows run."""
    from pricelens.operators.windows import fill_within_keys
    w = spec(keys, order)
    x = fill_within_keys(panel_wx, WEATHER_COLUMNS, keys, order)
    x = x.withColumn("price_change", F.col("modal_price") - lag("modal_price", 1, w))
    return x.na.drop(subset=CRISIS_REQUIRED)


def crisis_scores(df: DataFrame, keys=("commodity", "district"), order=("date",)) -> DataFrame:
    """D1-D5 on a panel with weather columns.

    ``keys``/``order`` default to the per-(commodity, district) series; the
    reference's commodity-only windows are ``keys=("commodity",),
    order=("date", "district")``.
    """
    w = spec(keys, order)
    prev = lag("modal_price", 1, w)
    chg = pct_change("modal_price", prev)
    df = df.select("*", chg.alias("price_change_pct"))
    df = add_rolling_zscore(df, "arrival", keys, order, ROLL_N, ROLL_MIN, name="arrival")
    df = add_rolling_zscore(df, "modal_price", keys, order, ROLL_N, ROLL_MIN, name="price")
    dev_pct = pct(F.col("arrival") - F.col("arrival_rolling_mean"), F.col("arrival_rolling_mean"))
    anomaly = (F.abs("price_zscore") >= ANOMALY_Z) | (F.abs("arrival_zscore") >= ANOMALY_Z)
    df = df.select(
        "*",
        dev_pct.alias("arrival_deviation_pct"),
        price_stress(F.abs("price_change_pct")).alias("price_stress"),
        supply_stress(dev_pct).alias("supply_stress"),
        weather_stress("max_temp", "rainfall_mm", "wind").alias("weather_stress"),
        F.when(anomaly, 3).otherwise(0).alias("anomaly_stress"))
    df = df.withColumn("crisis_score", crisis_score("price_stress", "supply_stress",
                                                    "weather_stress", "anomaly_stress"))
    return df.withColumn("crisis_level", crisis_level("crisis_score"))


# D15 ------------------------------------------------------------------------
SHOCK_TYPES = ("Price + Supply Shock", "Price Shock", "Supply Shock", "Other Abnormal Event")


def shock_type(flagged, price_z, arrival_z) -> Column:
    """Label of a flagged outlier; z-scores missing count as 0."""
    f = col(flagged)
    ps = F.abs(F.coalesce(col(price_z), F.lit(0.0))) >= ANOMALY_Z
    ss = F.abs(F.coalesce(col(arrival_z), F.lit(0.0))) >= ANOMALY_Z
    return (F.when(f & ps & ss, F.lit(SHOCK_TYPES[0]))
             .when(f & ps, F.lit(SHOCK_TYPES[1]))
             .when(f & ss, F.lit(SHOCK_TYPES[2]))
             .otherwise(F.lit(SHOCK_TYPES[3])))


def event_type(flagged) -> Column:
    """Outlier flag -> "Abnormal Event" / "Normal"."""
    return F.when(col(flagged), F.lit("Abnormal Event")).otherwise(F.lit("Normal"))
