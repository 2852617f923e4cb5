"""Crisis-score queries (D1-D6, L2, L3) and the scoring layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.functions import q4
from pricelens.operators import intelligence as I
from pricelens.operators.panel import panel_with_weather
from pricelens.operators.scores import CRISIS_LEVEL_ORDER, crisis_input, crisis_scores
from pricelens.plans.registry import register
from pricelens.plans.sqlviews import q4 as sq4, with_views
from pricelens.sources.adapter import price_panel

K = ("commodity", "district")
CRISIS_OUT = ["date", "commodity", "district", "modal_price", "arrival", "price_change_pct",
              "arrival_deviation_pct", "price_zscore", "arrival_zscore", "price_stress",
              "supply_stress", "weather_stress", "anomaly_stress", "crisis_score", "crisis_level"]
_DOUBLES = {"modal_price", "arrival", "price_change_pct", "arrival_deviation_pct", "price_zscore",
            "arrival_zscore", "crisis_score"}


PANEL_TABLES = ("lineitem", "part", "supplier", "nation", "region", "orders", "customer")


def crisis_frame(spark, sf_dir, keys=K, order=("date",)):
    """Crisis rows, stored once per input snapshot as a stage table (the
    reference's crisis-score output consumed by the scoring layer)."""
    from pricelens.sources.store import materialized
    from pricelens.sources.tables import table_path
    name = "crisis_" + "_".join(keys) + "__" + "_".join(order)
    return materialized(spark, name, [table_path(sf_dir, t) for t in PANEL_TABLES],
                        lambda: crisis_scores(crisis_input(panel_with_weather(spark, sf_dir), keys, order),
                                              keys, order))


def _out(df):
    return df.select(*[q4(c).alias(c) if c in _DOUBLES else F.col(c) for c in CRISIS_OUT])


def crisis_sql_ctes(partition="commodity, district", order="date"):
    w = f"PARTITION BY {partition} ORDER BY {order}"
    r30 = "ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"
    def fill(c):
        return (f"coalesce(first_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), "
                f"last_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS {c}")
    filled = ("SELECT commodity, district, date, modal_price, arrival, "
              + ", ".join(fill(c) for c in ("max_temp", "min_temp", "rainfall_mm", "wind")) + " FROM panel_wx")
    ci = f"""
SELECT * FROM (SELECT p.*, modal_price - lag(modal_price, 1) OVER ({w}) AS price_change FROM ({filled}) p)
WHERE date IS NOT NULL AND commodity IS NOT NULL AND modal_price IS NOT NULL AND arrival IS NOT NULL
  AND price_change IS NOT NULL AND max_temp IS NOT NULL AND min_temp IS NOT NULL AND rainfall_mm IS NOT NULL
  AND wind IS NOT NULL"""
    f = f"""
SELECT commodity, district, date, modal_price, arrival, max_temp, rainfall_mm, wind,
  (modal_price / NULLIF(lag(modal_price, 1) OVER ({w}), 0) - 1) * 100 AS price_change_pct,
  CASE WHEN count(arrival) OVER ({w} {r30}) >= 5 THEN avg(arrival) OVER ({w} {r30}) END AS am,
  CASE WHEN count(arrival) OVER ({w} {r30}) >= 5 THEN stddev_samp(arrival) OVER ({w} {r30}) END AS asd,
  CASE WHEN count(modal_price) OVER ({w} {r30}) >= 5 THEN avg(modal_price) OVER ({w} {r30}) END AS pm,
  CASE WHEN count(modal_price) OVER ({w} {r30}) >= 5 THEN stddev_samp(modal_price) OVER ({w} {r30}) END AS psd
FROM crisis_in"""
    g = """
SELECT *, ((arrival - am) * 100) / NULLIF(am, 0) AS arrival_deviation_pct,
       (modal_price - pm) / NULLIF(psd, 0) AS price_zscore,
       (arrival - am) / NULLIF(asd, 0) AS arrival_zscore
FROM cf"""
    s = """
SELECT *,
  CASE WHEN abs(price_change_pct) >= 30 THEN 3 WHEN abs(price_change_pct) >= 20 THEN 2
       WHEN abs(price_change_pct) >= 10 THEN 1 ELSE 0 END AS price_stress,
  CASE WHEN arrival_deviation_pct <= -50 THEN 3 WHEN arrival_deviation_pct <= -30 THEN 2
       WHEN arrival_deviation_pct <= -15 THEN 1 ELSE 0 END AS supply_stress,
  LEAST(CASE WHEN max_temp >= 40 THEN 2 WHEN max_temp >= 35 THEN 1 ELSE 0 END
      + CASE WHEN rainfall_mm >= 100 THEN 2 WHEN rainfall_mm >= 50 THEN 1 ELSE 0 END
      + CASE WHEN wind >= 30 THEN 1 ELSE 0 END, 3) AS weather_stress,
  CASE WHEN abs(price_zscore) >= 2 OR abs(arrival_zscore) >= 2 THEN 3 ELSE 0 END AS anomaly_stress
FROM cg"""
    c = """
SELECT *, LEAST(GREATEST((price_stress * 0.35::DOUBLE + supply_stress * 0.30::DOUBLE
                          + weather_stress * 0.20::DOUBLE + anomaly_stress * 0.15::DOUBLE)
                         / 3.0::DOUBLE * 100.0::DOUBLE, 0.0::DOUBLE), 100.0::DOUBLE) AS crisis_score
FROM cs"""
    lv = """
SELECT *, CASE WHEN crisis_score >= 80 THEN 'Critical' WHEN crisis_score >= 60 THEN 'High'
               WHEN crisis_score >= 30 THEN 'Moderate' ELSE 'Low' END AS crisis_level
FROM cc"""
    return [("crisis_in", ci), ("cf", f), ("cg", g), ("cs", s), ("cc", c), ("crisis", lv)]


def _crisis_select(src="crisis"):
    cols = []
    for c in CRISIS_OUT:
        cols.append(f"{sq4(c)} AS {c}" if c in _DOUBLES else c)
    return f"SELECT {', '.join(cols)} FROM {src}"


def crisis_sql(body, partition="commodity, district", order="date", extra=()):
    return with_views(["panel_wx"], body, crisis_sql_ctes(partition, order) + list(extra))


@register("crisis_scores", "D1 D2 D3 D4 D5 W7 W9 W10 J1", sql=crisis_sql(_crisis_select()))
def q_crisis_scores(spark, sf_dir):
    return _out(crisis_frame(spark, sf_dir))


@register("crisis_scores_commodity_windows", "D1-D5 compat (X11)",
          sql=crisis_sql(_crisis_select(), "commodity", "date, district"))
def q_crisis_scores_compat(spark, sf_dir):
    return _out(crisis_frame(spark, sf_dir, ("commodity",), ("date", "district")))


@register("crisis_level_distribution", "D6 A2 L3", sql=crisis_sql("""
SELECT lv.crisis_level, lv.level_order, CAST(COALESCE(c.events, 0) AS BIGINT) AS events
FROM (VALUES ('Low', 1), ('Moderate', 2), ('High', 3), ('Critical', 4)) lv(crisis_level, level_order)
LEFT JOIN (SELECT crisis_level, COUNT(*) AS events FROM crisis GROUP BY 1) c
  ON lv.crisis_level = c.crisis_level"""))
def q_crisis_level_distribution(spark, sf_dir):
    levels = spark.createDataFrame([(n, i + 1) for i, n in enumerate(CRISIS_LEVEL_ORDER)],
                                   "crisis_level string, level_order int")
    counts = crisis_frame(spark, sf_dir).groupBy("crisis_level").agg(F.count(F.lit(1)).alias("events"))
    return (levels.join(counts, "crisis_level", "left")
                  .select("crisis_level", "level_order",
                          F.coalesce("events", F.lit(0)).cast("bigint").alias("events"))
                  .orderBy("level_order"))


@register("crisis_by_commodity", "D6 A1", sql=crisis_sql(f"""
SELECT commodity, {sq4('AVG(crisis_score)')} AS avg_crisis_score,
       CAST(COUNT(*) AS BIGINT) AS rows_scored,
       CAST(COUNT(*) FILTER (WHERE crisis_level IN ('High', 'Critical')) AS BIGINT) AS high_or_critical
FROM crisis GROUP BY commodity"""))
def q_crisis_by_commodity(spark, sf_dir):
    c = crisis_frame(spark, sf_dir)
    return (c.groupBy("commodity")
             .agg(q4(F.avg("crisis_score")).alias("avg_crisis_score"),
                  F.count(F.lit(1)).alias("rows_scored"),
                  F.count_if(F.col("crisis_level").isin("High", "Critical")).alias("high_or_critical"))
             .orderBy(F.desc("avg_crisis_score")))


@register("crisis_top20", "D6 L2", sql=crisis_sql(
    _crisis_select() + " ORDER BY crisis_score DESC, date, commodity, district LIMIT 20"))
def q_crisis_top20(spark, sf_dir):
    return _out(crisis_frame(spark, sf_dir)).orderBy(
        F.desc("crisis_score"), "date", "commodity", "district").limit(20)


@register("crisis_early_warning", "D6 P17", sql=crisis_sql(
    _crisis_select() + " WHERE crisis_level IN ('High', 'Critical')"))
def q_crisis_early_warning(spark, sf_dir):
    return _out(crisis_frame(spark, sf_dir)).filter(F.col("crisis_level").isin("High", "Critical"))


# ---------------------------------------------------------------------------------
# Scoring layer D7-D14 (forecast = baseline drift forecast; outliers = z-score events)
# ---------------------------------------------------------------------------------

_REC_CASE_TEXT = "CASE rule_id " + " ".join(
    "WHEN {} THEN '{}'".format(i, t.replace("'", "''")) for i, t, _ in I.RECOMMENDATIONS) + " END"
_REC_CASE_ACTION = "CASE rule_id " + " ".join(f"WHEN {i} THEN '{a}'" for i, _, a in I.RECOMMENDATIONS) + " END"


def _lvl(x):
    return f"CASE WHEN {x} >= 70 THEN 'Critical' WHEN {x} >= 50 THEN 'High' WHEN {x} >= 25 THEN 'Moderate' ELSE 'Low' END"


def _clip(x):
    return f"LEAST(GREATEST({x}, 0.0::DOUBLE), 100.0::DOUBLE)"


INTEL_CTES = [
    ("fc_hist", "SELECT commodity, district, date, modal_price, lag(modal_price, 29) OVER (PARTITION BY commodity, district ORDER BY date) AS back FROM price_panel"),
    ("fc_last", "SELECT commodity, district, MAX(date) AS last_date, arg_max(modal_price, date) AS last_price, arg_max(back, date) AS back_price FROM fc_hist GROUP BY 1, 2 HAVING COUNT(*) >= 30"),
    ("forecast", """SELECT CAST(last_date + CAST(h AS INTEGER) AS DATE) AS date, commodity, district,
       CASE WHEN v < 0 THEN 0.0::DOUBLE ELSE v END AS predicted_price
       FROM (SELECT *, last_price + h * ((last_price - back_price) / 29.0::DOUBLE) AS v FROM fc_last, range(1, 31) t(h))"""),
    ("fsum0", """SELECT commodity, AVG(predicted_price) AS forecast_average_price, MIN(predicted_price) AS forecast_min_price,
       MAX(predicted_price) AS forecast_max_price, stddev_samp(predicted_price) AS forecast_std,
       arg_min(predicted_price, (date, district)) AS forecast_first_price, arg_max(predicted_price, (date, district)) AS forecast_last_price
       FROM forecast GROUP BY 1"""),
    ("fsum", """SELECT commodity, round_even(forecast_average_price, 2) AS forecast_average_price, round_even(forecast_min_price, 2) AS forecast_min_price,
       round_even(forecast_max_price, 2) AS forecast_max_price, round_even(forecast_std, 2) AS forecast_std,
       round_even(forecast_first_price, 2) AS forecast_first_price, round_even(forecast_last_price, 2) AS forecast_last_price,
       round_even(((forecast_last_price - forecast_first_price) * 100) / NULLIF(forecast_first_price, 0), 2) AS forecast_change_pct,
       round_even(((forecast_max_price - forecast_min_price) * 100) / NULLIF(forecast_min_price, 0), 2) AS forecast_range_pct
       FROM fsum0"""),
    ("rsum", """SELECT c.commodity, round_even(avg_cs, 2) AS average_crisis_score, round_even(max_cs, 2) AS maximum_crisis_score,
       high AS high_critical_events, total AS total_crisis_records, round_even(COALESCE(CAST(o.n AS DOUBLE), 0.0::DOUBLE), 2) AS abnormal_events,
       round_even((high * 100.0::DOUBLE) / NULLIF(total, 0), 2) AS high_critical_pct
       FROM (SELECT commodity, AVG(crisis_score) AS avg_cs, MAX(crisis_score) AS max_cs,
               CAST(COUNT(*) FILTER (WHERE crisis_level IN ('High', 'Critical')) AS BIGINT) AS high,
               CAST(COUNT(crisis_level) AS BIGINT) AS total FROM crisis GROUP BY 1) c
       LEFT JOIN (SELECT commodity, COUNT(*) AS n FROM crisis WHERE anomaly_stress = 3 GROUP BY 1) o ON c.commodity = o.commodity"""),
    ("intel0", """SELECT f.*, r.average_crisis_score, r.maximum_crisis_score, r.high_critical_events, r.total_crisis_records,
       r.abnormal_events, r.high_critical_pct,
       CASE WHEN r.average_crisis_score IS NULL THEN NULL ELSE """ + _clip("r.average_crisis_score") + """ END AS crisis_risk_score,
       CASE WHEN MAX(f.forecast_std) OVER () > 0 THEN (f.forecast_std / MAX(f.forecast_std) OVER ()) * 100.0::DOUBLE ELSE 0.0::DOUBLE END AS forecast_volatility_score,
       CASE WHEN MAX(r.high_critical_events) OVER () > 0 THEN (r.high_critical_events / MAX(r.high_critical_events) OVER ()) * 100.0::DOUBLE ELSE 0.0::DOUBLE END AS crisis_event_score
       FROM fsum f LEFT JOIN rsum r ON f.commodity = r.commodity"""),
    ("intel1", "SELECT *, round_even(" + _clip("crisis_risk_score * 0.40::DOUBLE + forecast_volatility_score * 0.30::DOUBLE + crisis_event_score * 0.30::DOUBLE") + ", 2) AS farmer_intelligence_score FROM intel0"),
    ("intel", "SELECT *, " + _lvl("farmer_intelligence_score") + " AS final_risk_level FROM intel1"),
    ("dist0", """SELECT district, AVG(crisis_score) AS average_crisis_score, MAX(crisis_score) AS maximum_crisis_score,
       CAST(COUNT(*) FILTER (WHERE crisis_level IN ('High', 'Critical')) AS BIGINT) AS high_critical_events,
       CAST(COUNT(crisis_score) AS BIGINT) AS total_records, AVG(modal_price) AS average_price, AVG(arrival) AS average_arrival
       FROM crisis GROUP BY 1"""),
    ("dist1", "SELECT *, (high_critical_events * 100.0::DOUBLE) / NULLIF(total_records, 0) AS high_critical_pct FROM dist0"),
    ("dist2", "SELECT *, round_even(" + _clip(_clip("average_crisis_score") + " * 0.60::DOUBLE + " + _clip("high_critical_pct") + " * 0.40::DOUBLE") + ", 2) AS district_risk_score FROM dist1"),
    ("dintel", """SELECT district, round_even(average_crisis_score, 2) AS average_crisis_score, round_even(maximum_crisis_score, 2) AS maximum_crisis_score,
       high_critical_events, total_records, round_even(average_price, 2) AS average_price, round_even(average_arrival, 2) AS average_arrival,
       round_even(high_critical_pct, 2) AS high_critical_pct, district_risk_score, """ + _lvl("district_risk_score") + """ AS district_risk_level,
       (SELECT COUNT(DISTINCT average_price) = 1 FROM dist2) AS price_identical_across_districts,
       (SELECT COUNT(DISTINCT average_arrival) = 1 FROM dist2) AS arrival_identical_across_districts
       FROM dist2"""),
    ("reco0", """SELECT p.commodity, p.district, i.*  EXCLUDE (commodity), d.district_risk_score, d.district_risk_level,
       CASE WHEN d.district_risk_level = 'Critical' THEN 1 WHEN i.final_risk_level IN ('Critical', 'High') THEN 2
            WHEN i.forecast_volatility_score >= 70 THEN 3 WHEN i.forecast_change_pct <= -10 THEN 4
            WHEN i.forecast_change_pct >= 10 THEN 5 WHEN i.average_crisis_score >= 25 THEN 6 ELSE 7 END AS rule_id
       FROM (SELECT DISTINCT commodity, district FROM price_panel) p
       JOIN intel i ON p.commodity = i.commodity JOIN dintel d ON p.district = d.district"""),
    ("reco", f"SELECT *, {_REC_CASE_TEXT} AS recommendation, {_REC_CASE_ACTION} AS recommended_action FROM reco0"),
    ("best", """SELECT commodity, arg_min(district, (-a, district)) AS best_forecasted_district, MAX(a) AS best_district_forecast_average
       FROM (SELECT commodity, district, AVG(predicted_price) AS a FROM forecast GROUP BY 1, 2) GROUP BY 1"""),
]


def intel_sql(body):
    return with_views(["panel_wx", "price_panel"], body, crisis_sql_ctes() + INTEL_CTES)


def _sel(cols, src, dbl):
    return "SELECT " + ", ".join(f"{sq4(c)} AS {c}" if c in dbl else c for c in cols) + f" FROM {src}"


def _qd(df):
    dbl = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*[q4(c).alias(c) if c in dbl else F.col(c) for c in df.columns])


def _forecast(spark, sf_dir):
    """Baseline 30-day forecast table, stored once per input snapshot."""
    from pricelens.sources.store import materialized
    from pricelens.sources.tables import table_path
    return materialized(spark, "baseline_forecast", [table_path(sf_dir, t) for t in PANEL_TABLES[:5]],
                        lambda: I.drift_forecast(price_panel(spark, sf_dir)))


def _crisis(spark, sf_dir):
    return crisis_frame(spark, sf_dir)


def _outliers(c):
    return c.filter(F.col("anomaly_stress") == 3)


FC_COLS = ["date", "commodity", "district", "predicted_price"]
FSUM_COLS = ["commodity", "forecast_average_price", "forecast_min_price", "forecast_max_price", "forecast_std",
             "forecast_first_price", "forecast_last_price", "forecast_change_pct", "forecast_range_pct"]
RSUM_COLS = ["commodity", "average_crisis_score", "maximum_crisis_score", "high_critical_events",
             "total_crisis_records", "abnormal_events", "high_critical_pct"]
INTEL_COLS = FSUM_COLS + RSUM_COLS[1:] + ["crisis_risk_score", "forecast_volatility_score", "crisis_event_score",
                                          "farmer_intelligence_score", "final_risk_level"]
DINTEL_COLS = ["district", "average_crisis_score", "maximum_crisis_score", "high_critical_events", "total_records",
               "average_price", "average_arrival", "high_critical_pct", "district_risk_score", "district_risk_level",
               "price_identical_across_districts", "arrival_identical_across_districts"]
RECO_COLS = ["commodity", "district", "farmer_intelligence_score", "final_risk_level", "district_risk_score",
             "district_risk_level", "forecast_volatility_score", "forecast_change_pct", "average_crisis_score",
             "rule_id", "recommendation", "recommended_action"]
_ALLD = {"predicted_price", "forecast_average_price", "forecast_min_price", "forecast_max_price", "forecast_std",
         "forecast_first_price", "forecast_last_price", "forecast_change_pct", "forecast_range_pct",
         "average_crisis_score", "maximum_crisis_score", "abnormal_events", "high_critical_pct", "crisis_risk_score",
         "forecast_volatility_score", "crisis_event_score", "farmer_intelligence_score", "average_price",
         "average_arrival", "district_risk_score", "best_district_forecast_average"}


@register("baseline_forecast", "P20 U4", sql=intel_sql(_sel(FC_COLS, "forecast", _ALLD)))
def q_baseline_forecast(spark, sf_dir):
    return _qd(_forecast(spark, sf_dir).select(*FC_COLS))


@register("forecast_summary", "D7 A15", sql=intel_sql(_sel(FSUM_COLS, "fsum", _ALLD)))
def q_forecast_summary(spark, sf_dir):
    return _qd(I.forecast_summary(_forecast(spark, sf_dir)).select(*FSUM_COLS))


@register("risk_summary", "D8 J7 A14", sql=intel_sql(_sel(RSUM_COLS, "rsum", _ALLD)))
def q_risk_summary(spark, sf_dir):
    c = _crisis(spark, sf_dir)
    return _qd(I.risk_summary(c, _outliers(c)).select(*RSUM_COLS))


def _intel(spark, sf_dir):
    c = _crisis(spark, sf_dir)
    return I.farmer_intelligence(I.forecast_summary(_forecast(spark, sf_dir)), I.risk_summary(c, _outliers(c)))


@register("farmer_intelligence", "D9 A20", sql=intel_sql(_sel(INTEL_COLS, "intel", _ALLD)))
def q_farmer_intelligence(spark, sf_dir):
    return _qd(_intel(spark, sf_dir).select(*INTEL_COLS))


@register("district_intelligence", "D10 A14 A12", sql=intel_sql(_sel(DINTEL_COLS, "dintel", _ALLD)))
def q_district_intelligence(spark, sf_dir):
    return _qd(I.district_intelligence(_crisis(spark, sf_dir)).select(*DINTEL_COLS))


def _reco(spark, sf_dir):
    pairs = price_panel(spark, sf_dir).select("commodity", "district").distinct()
    return I.recommendations(pairs, _intel(spark, sf_dir), I.district_intelligence(_crisis(spark, sf_dir)))


@register("recommendations", "D12 J9 J8", sql=intel_sql(_sel(RECO_COLS, "reco", _ALLD)))
def q_recommendations(spark, sf_dir):
    return _qd(_reco(spark, sf_dir).select(*RECO_COLS))


@register("best_forecast_district", "D13 W12", sql=intel_sql(_sel(
    ["commodity", "best_forecasted_district", "best_district_forecast_average"], "best", _ALLD)))
def q_best_forecast_district(spark, sf_dir):
    return _qd(I.best_forecast_district(_forecast(spark, sf_dir)))


@register("master_table", "D14 J8 L1", sql=intel_sql(
    _sel(I.MASTER_COLUMNS, "(SELECT r.*, b.best_forecasted_district, b.best_district_forecast_average FROM reco r LEFT JOIN best b ON r.commodity = b.commodity)", _ALLD)))
def q_master_table(spark, sf_dir):
    m = I.master_table(_reco(spark, sf_dir), I.best_forecast_district(_forecast(spark, sf_dir)))
    return _qd(m).orderBy("commodity", "district")
