"""Scoring layer (D7-D14): forecast and risk summaries, farmer and district
intelligence, the recommendation rule chain and the master table.

Inputs are the crisis rows (large: one per commodity, district, day) and a
forecast table (30 rows per commodity x district).  Both are reduced by one
grouped aggregate each; everything after that has one row per commodity,
district or (commodity, district) and is joined by broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions import clip, col, pct
from pricelens.operators.windows import spec
from pricelens.operators.stats import attach, broadcast_if_small

# Fixed values -------------------------------------------------------------------
HIGH_LEVELS = ("High", "Critical")
INTEL_WEIGHTS = (0.40, 0.30, 0.30)        # crisis risk, forecast volatility, crisis events
DISTRICT_WEIGHTS = (0.60, 0.40)           # avg crisis score, high/critical %
RISK_CUTS = ((70.0, "Critical"), (50.0, "High"), (25.0, "Moderate"))
FORECAST_DAYS = 30
MIN_HISTORY = 30

RECOMMENDATIONS = [
    # (rule id, text, action)
    (1, "Critical district risk - monitor the market closely, avoid distress selling, and compare nearby mandi prices before selling.", "AVOID DISTRESS SELLING"),
    (2, "High commodity risk - avoid selling the entire stock at once and monitor price and supply conditions.", "MONITOR MARKET"),
    (3, "High forecast volatility - avoid making a single large selling decision and monitor price movement.", "MONITOR MARKET"),
    (4, "Price decline expected - consider selling gradually while monitoring market conditions.", "SELL GRADUALLY"),
    (5, "Positive price trend expected - consider holding part of the stock if storage is available.", "CONSIDER HOLDING"),
    (6, "Moderate historical risk - monitor mandi prices, supply conditions, and weather before selling.", "MONITOR MARKET"),
    (7, "Stable conditions - monitor mandi prices, supply conditions, and weather before making a decision.", "MONITOR MARKET"),
]


def risk_level(score) -> Column:
    s = col(score)
    out = F.when(s >= RISK_CUTS[0][0], RISK_CUTS[0][1])
    for cut, name in RISK_CUTS[1:]:
        out = out.when(s >= cut, name)
    return out.otherwise("Low")


def r2(c) -> Column:
    """pandas ``round(2)`` (half-even)."""
    return F.bround(col(c), 2)


# Baseline forecast ---------------------------------------------------------------
def drift_forecast(panel: DataFrame, days: int = FORECAST_DAYS, min_history: int = MIN_HISTORY) -> DataFrame:
    """Naive drift forecast per (commodity, district): last price plus the mean
    daily move of the last ``min_history`` rows, clamped at 0.  Keys with fewer
    than ``min_history`` rows are skipped.  Output: date, commodity, district,
    predicted_price (``days`` rows per key).
    """
    w = spec(["commodity", "district"], "date")
    h = panel.select("commodity", "district", "date", "modal_price",
                     F.lag("modal_price", min_history - 1).over(w).alias("_back"))
    last = h.groupBy("commodity", "district").agg(
        F.max("date").alias("last_date"), F.max_by("modal_price", "date").alias("last_price"),
        F.max_by("_back", "date").alias("back_price"), F.count(F.lit(1)).alias("_n"))
    last = last.filter(F.col("_n") >= min_history)
    drift = (F.col("last_price") - F.col("back_price")) / F.lit(float(min_history - 1))
    f = last.select("commodity", "district", "last_date", "last_price", drift.alias("drift"),
                    F.explode(F.sequence(F.lit(1), F.lit(days))).alias("h"))
    pred = F.col("last_price") + F.col("h") * F.col("drift")
    return f.select(F.date_add("last_date", F.col("h")).alias("date"), "commodity", "district",
                    clip(pred, lo=0.0).alias("predicted_price"))


# D7 --------------------------------------------------------------------------------
def forecast_summary(forecast: DataFrame) -> DataFrame:
    k = F.struct("date", "district")
    g = forecast.groupBy("commodity").agg(
        F.avg("predicted_price").alias("forecast_average_price"),
        F.min("predicted_price").alias("forecast_min_price"),
        F.max("predicted_price").alias("forecast_max_price"),
        F.stddev_samp("predicted_price").alias("forecast_std"),
        F.min_by("predicted_price", k).alias("forecast_first_price"),
        F.max_by("predicted_price", k).alias("forecast_last_price"))
    g = g.withColumns({
        "forecast_change_pct": pct(F.col("forecast_last_price") - F.col("forecast_first_price"), F.col("forecast_first_price")),
        "forecast_range_pct": pct(F.col("forecast_max_price") - F.col("forecast_min_price"), F.col("forecast_min_price"))})
    return g.select("commodity", *[r2(c).alias(c) for c in g.columns if c != "commodity"])


# D8 --------------------------------------------------------------------------------
def risk_summary(crisis: DataFrame, outlier_events: DataFrame | None) -> DataFrame:
    c = crisis.groupBy("commodity").agg(
        F.avg("crisis_score").alias("average_crisis_score"),
        F.max("crisis_score").alias("maximum_crisis_score"),
        F.count_if(F.col("crisis_level").isin(*HIGH_LEVELS)).alias("high_critical_events"),
        F.count("crisis_level").alias("total_crisis_records"))
    if outlier_events is None:  # absent table = zero rows
        o = crisis.sparkSession.createDataFrame([], "commodity string, abnormal_events long")
    else:
        o = outlier_events.groupBy("commodity").agg(F.count(F.lit(1)).alias("abnormal_events"))
    r = c.join(broadcast_if_small(o), "commodity", "left").withColumn(
        "abnormal_events", F.coalesce(F.col("abnormal_events").cast("double"), F.lit(0.0)))
    r = r.withColumn("high_critical_pct", pct(F.col("high_critical_events"), F.col("total_crisis_records")))
    return r.withColumns({c: r2(c) for c in ["average_crisis_score", "maximum_crisis_score",
                                             "high_critical_pct", "abnormal_events"]})


# D9 --------------------------------------------------------------------------------
def farmer_intelligence(fsum: DataFrame, rsum: DataFrame) -> DataFrame:
    f = fsum.join(rsum, "commodity", "left")
    mx = f.agg(F.max("forecast_std").alias("_mv"), F.max("high_critical_events").alias("_me"))
    f = attach(f, mx)
    vol = F.when(F.col("_mv") > 0, F.try_divide(F.col("forecast_std"), F.col("_mv")) * F.lit(100.0)).otherwise(F.lit(0.0))
    ev = F.when(F.col("_me") > 0, F.try_divide(F.col("high_critical_events"), F.col("_me")) * F.lit(100.0)).otherwise(F.lit(0.0))
    f = f.withColumns({"crisis_risk_score": clip("average_crisis_score", 0.0, 100.0),
                       "forecast_volatility_score": vol, "crisis_event_score": ev}).drop("_mv", "_me")
    a, b, c = INTEL_WEIGHTS
    s = F.col("crisis_risk_score") * a + F.col("forecast_volatility_score") * b + F.col("crisis_event_score") * c
    f = f.withColumn("farmer_intelligence_score", r2(clip(s, 0.0, 100.0)))
    return f.withColumn("final_risk_level", risk_level("farmer_intelligence_score"))


# D10 -------------------------------------------------------------------------------
def district_intelligence(crisis: DataFrame) -> DataFrame:
    d = crisis.groupBy("district").agg(
        F.avg("crisis_score").alias("average_crisis_score"),
        F.max("crisis_score").alias("maximum_crisis_score"),
        F.count_if(F.col("crisis_level").isin(*HIGH_LEVELS)).alias("high_critical_events"),
        F.count("crisis_score").alias("total_records"),
        F.avg("modal_price").alias("average_price"), F.avg("arrival").alias("average_arrival"))
    d = d.withColumn("high_critical_pct", pct(F.col("high_critical_events"), F.col("total_records")))
    a, b = DISTRICT_WEIGHTS
    s = clip("average_crisis_score", 0.0, 100.0) * a + clip("high_critical_pct", 0.0, 100.0) * b
    d = d.withColumn("district_risk_score", r2(clip(s, 0.0, 100.0)))
    d = d.withColumn("district_risk_level", risk_level("district_risk_score"))
    # constant-value warnings: one distinct value across all districts
    flags = d.agg((F.count_distinct("average_price") == 1).alias("price_identical_across_districts"),
                  (F.count_distinct("average_arrival") == 1).alias("arrival_identical_across_districts"))
    d = attach(d, flags)
    return d.withColumns({c: r2(c) for c in ["average_crisis_score", "maximum_crisis_score",
                                             "high_critical_pct", "average_price", "average_arrival"]})


# D12 -------------------------------------------------------------------------------
def recommendation_rule(district_level, final_level, volatility, change_pct, crisis_score) -> Column:
    return (F.when(col(district_level) == "Critical", 1)
             .when(col(final_level).isin("Critical", "High"), 2)
             .when(col(volatility) >= 70, 3)
             .when(col(change_pct) <= -10, 4)
             .when(col(change_pct) >= 10, 5)
             .when(col(crisis_score) >= 25, 6)
             .otherwise(7))


def _lookup(rule, idx):
    m = F.create_map(*[x for r in RECOMMENDATIONS for x in (F.lit(r[0]), F.lit(r[idx]))])
    return F.element_at(m, rule)


def recommendations(pairs: DataFrame, intel: DataFrame, dintel: DataFrame) -> DataFrame:
    """Commodity x district grid (observed pairs, J9) with the rule chain.

    The grid is the set of (commodity, district) pairs present in the data:
    equal to the full cross product whenever the panel is complete (see the
    ``panel_completeness`` check), and it never invents pairs that do not trade.
    """
    d = dintel.select("district", "district_risk_score", "district_risk_level")
    g = pairs.join(broadcast_if_small(intel), "commodity").join(broadcast_if_small(d), "district")
    rule = recommendation_rule("district_risk_level", "final_risk_level", "forecast_volatility_score",
                               "forecast_change_pct", "average_crisis_score")
    g = g.withColumn("rule_id", rule)
    return g.withColumns({"recommendation": _lookup(F.col("rule_id"), 1),
                          "recommended_action": _lookup(F.col("rule_id"), 2)})


# D13 -------------------------------------------------------------------------------
def best_forecast_district(forecast: DataFrame) -> DataFrame:
    a = forecast.groupBy("commodity", "district").agg(F.avg("predicted_price").alias("best_district_forecast_average"))
    return a.groupBy("commodity").agg(
        F.min_by("district", F.struct((-F.col("best_district_forecast_average")).alias("k"),
                                      F.col("district").alias("t"))).alias("best_forecasted_district"),
        F.max("best_district_forecast_average").alias("best_district_forecast_average"))


MASTER_COLUMNS = ["commodity", "forecast_average_price", "forecast_min_price", "forecast_max_price",
                  "forecast_change_pct", "forecast_volatility_score", "average_crisis_score",
                  "high_critical_events", "farmer_intelligence_score", "final_risk_level", "district",
                  "district_risk_score", "district_risk_level", "best_forecasted_district",
                  "best_district_forecast_average", "recommendation", "recommended_action"]


# D14 -------------------------------------------------------------------------------
def master_table(reco: DataFrame, best: DataFrame) -> DataFrame:
    m = reco.join(broadcast_if_small(best), "commodity", "left")
    return m.select(*MASTER_COLUMNS)
