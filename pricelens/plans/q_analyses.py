"""Stakeholder-analysis queries (N1-N22) with DuckDB oracles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pricelens.functions import q4
from pricelens.operators import analyses as N
from pricelens.operators.panel import feature_panel, panel_with_weather
from pricelens.plans.q_aggregates import corr_sql
from pricelens.plans.registry import register
from pricelens.plans.sqlviews import q4 as sq4, with_views
from pricelens.sources.adapter import calendar, cost_dim, price_panel

# Test-data events for the event study (N6): the reference studies one policy
# announcement date; the same month/day inside the test-data years is used,
# plus a second event to exercise several windows at once.
EVENTS = [("policy_announcement", dt.date(1998, 12, 8)), ("mid_year_review", dt.date(1997, 7, 1))]


def _qall(df):
    dbl = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*[q4(c).alias(c) if c in dbl else F.col(c) for c in df.columns])


MONTHS_SQL = "['January','February','March','April','May','June','July','August','September','October','November','December']"


@register("cheapest_dearest_month", "N1 A1 A22 J3", sql=with_views(["price_panel"], f"""
SELECT commodity,
  {MONTHS_SQL}[arg_min(month, (avg_price, month))] AS cheapest_month, {sq4('MIN(avg_price)')} AS cheapest_price,
  {MONTHS_SQL}[arg_min(month, (-avg_price, month))] AS dearest_month, {sq4('MAX(avg_price)')} AS dearest_price
FROM (SELECT commodity, CAST(month(date) AS INTEGER) AS month, AVG(modal_price) AS avg_price FROM price_panel GROUP BY 1, 2)
GROUP BY 1"""))
def q_cheapest_dearest_month(spark, sf_dir):
    return _qall(N.cheapest_dearest_month(price_panel(spark, sf_dir)))


RAIN_ROWS = """
SELECT *, lag(rainfall_mm, 18) OVER (PARTITION BY commodity, district ORDER BY date) AS rainfall_lag_18,
  ((lead(modal_price, 18) OVER (PARTITION BY commodity, district ORDER BY date) - modal_price) * 100) / NULLIF(modal_price, 0) AS price_change_18d
FROM panel_wx"""
RAIN_THR = "SELECT quantile_cont(rainfall_mm, 0.9) AS threshold FROM panel_wx"


@register("rain_lag_summary", "N2 W2 W3 A10 A7", sql=with_views(["panel_wx"], f"""
SELECT {sq4('threshold')} AS threshold, {sq4(corr_sql('rainfall_lag_18', 'modal_price'))} AS lag18_correlation,
  CAST(COUNT(*) FILTER (WHERE v AND rainfall_mm >= threshold) AS BIGINT) AS heavy_n,
  CAST(COUNT(*) FILTER (WHERE v AND rainfall_mm < threshold) AS BIGINT) AS normal_n,
  {sq4('AVG(price_change_18d) FILTER (WHERE v AND rainfall_mm >= threshold)')} AS heavy_avg_change,
  {sq4('AVG(price_change_18d) FILTER (WHERE v AND rainfall_mm < threshold)')} AS normal_avg_change,
  CASE WHEN AVG(price_change_18d) FILTER (WHERE v AND rainfall_mm >= threshold) > AVG(price_change_18d) FILTER (WHERE v AND rainfall_mm < threshold)
    THEN printf('Average change 18 days after heavy rain: %.2f%%, above the %.2f%% after ordinary days.',
      AVG(price_change_18d) FILTER (WHERE v AND rainfall_mm >= threshold), AVG(price_change_18d) FILTER (WHERE v AND rainfall_mm < threshold))
    ELSE printf('Average change 18 days after heavy rain: %.2f%%, not above the %.2f%% after ordinary days.',
      AVG(price_change_18d) FILTER (WHERE v AND rainfall_mm >= threshold), AVG(price_change_18d) FILTER (WHERE v AND rainfall_mm < threshold)) END AS conclusion
FROM (SELECT r.*, t.threshold, (r.rainfall_mm IS NOT NULL AND r.price_change_18d IS NOT NULL) AS v FROM rain_rows r, thr t)
GROUP BY threshold""", [("rain_rows", RAIN_ROWS), ("thr", RAIN_THR)]))
def q_rain_lag_summary(spark, sf_dir):
    s = N.rain_lag_summary(panel_with_weather(spark, sf_dir))
    return _qall(s.select("threshold", "lag18_correlation", "heavy_n", "normal_n", "heavy_avg_change",
                          "normal_avg_change", "conclusion"))


@register("rain_lag_by_commodity", "N2 A3", sql=with_views(["panel_wx"], f"""
SELECT commodity, {sq4('AVG(price_change_18d)')} AS mean_change, {sq4('quantile_cont(price_change_18d, 0.5)')} AS median_change,
       CAST(COUNT(price_change_18d) AS BIGINT) AS n
FROM rain_rows, thr WHERE rainfall_mm IS NOT NULL AND price_change_18d IS NOT NULL AND rainfall_mm >= threshold
GROUP BY 1""", [("rain_rows", RAIN_ROWS), ("thr", RAIN_THR)]))
def q_rain_lag_by_commodity(spark, sf_dir):
    return _qall(N.rain_lag_by_commodity(panel_with_weather(spark, sf_dir)))


@register("festival_period_prices", "N3 J10 P18", sql=with_views(["price_panel", "calendar"], f"""
SELECT commodity,
  {sq4('AVG(modal_price) FILTER (WHERE inp)')} AS period_mean, {sq4('AVG(modal_price) FILTER (WHERE NOT inp)')} AS normal_mean,
  {sq4('quantile_cont(modal_price, 0.5) FILTER (WHERE inp)')} AS period_median,
  {sq4('quantile_cont(modal_price, 0.5) FILTER (WHERE NOT inp)')} AS normal_median,
  CAST(COUNT(*) FILTER (WHERE inp) AS BIGINT) AS period_rows,
  {sq4('((AVG(modal_price) FILTER (WHERE inp) - AVG(modal_price) FILTER (WHERE NOT inp)) * 100) / NULLIF(AVG(modal_price) FILTER (WHERE NOT inp), 0)')} AS pct_difference
FROM (SELECT p.*, EXISTS (SELECT 1 FROM calendar c WHERE c.festival = 'Gandhi Jayanti'
        AND p.date BETWEEN c.date - INTERVAL 4 DAY AND c.date + INTERVAL 4 DAY) AS inp FROM price_panel p)
GROUP BY 1"""))
def q_festival_period_prices(spark, sf_dir):
    periods = N.festival_periods(calendar(spark, sf_dir))
    return _qall(N.period_comparison(price_panel(spark, sf_dir), periods))


@register("take_home_income", "N5 A5", sql=with_views(["price_panel"], f"""
SELECT commodity, {sq4('AVG(modal_price)')} AS average_modal_price,
  {sq4('AVG(net / NULLIF(qty, 0))')} AS average_net_income_per_quintal,
  {sq4('AVG(gross)')} AS average_gross_income, {sq4('AVG(cost)')} AS average_total_cost
FROM (SELECT commodity, modal_price, qty, gross, cost, gross - cost AS net FROM (
  SELECT commodity, modal_price, qty, gross,
         gross * 0.02::DOUBLE + qty * 80.0::DOUBLE + qty * 50.0::DOUBLE AS cost
  FROM (SELECT commodity, modal_price, arrival * 10.0::DOUBLE AS qty, arrival * 10.0::DOUBLE * modal_price AS gross FROM price_panel)))
GROUP BY 1"""))
def q_take_home_income(spark, sf_dir):
    return _qall(N.take_home_income(price_panel(spark, sf_dir)))


def _events(spark):
    return spark.createDataFrame(EVENTS, "event string, event_date date")


_EV_SQL = ", ".join(f"('{n}', DATE '{d.isoformat()}')" for n, d in EVENTS)


@register("event_study", "N6 J11 A22", sql=with_views(["price_panel"], f"""
SELECT s.commodity, s.event, s.event_date, {sq4('before_mean')} AS before_mean, {sq4('after_mean')} AS after_mean,
  {sq4('after_mean - before_mean')} AS price_difference,
  {sq4('((after_mean - before_mean) * 100) / NULLIF(before_mean, 0)')} AS price_change_pct,
  {sq4('m.price')} AS lowest_price, m.date AS lowest_date, CAST(datediff('day', s.event_date, m.date) AS INTEGER) AS days_to_lowest,
  {sq4('lowest_30d_price')} AS lowest_30d_price, lowest_30d_date,
  CAST(datediff('day', s.event_date, lowest_30d_date) AS INTEGER) AS days_to_lowest_30d,
  {sq4('before_mean - lowest_30d_price')} AS fall_from_before,
  {sq4('((before_mean - lowest_30d_price) * 100) / NULLIF(before_mean, 0)')} AS fall_pct
FROM (SELECT d.commodity, e.event, e.event_date,
        AVG(price) FILTER (WHERE d.date BETWEEN e.event_date - INTERVAL 30 DAY AND e.event_date - INTERVAL 1 DAY) AS before_mean,
        AVG(price) FILTER (WHERE d.date BETWEEN e.event_date AND e.event_date + INTERVAL 30 DAY) AS after_mean,
        arg_min(d.date, (price, d.date)) FILTER (WHERE d.date BETWEEN e.event_date AND e.event_date + INTERVAL 30 DAY) AS lowest_30d_date,
        MIN(price) FILTER (WHERE d.date BETWEEN e.event_date AND e.event_date + INTERVAL 30 DAY) AS lowest_30d_price
      FROM daily d, ev e WHERE d.date BETWEEN e.event_date - INTERVAL 30 DAY AND e.event_date + INTERVAL 30 DAY
      GROUP BY 1, 2, 3) s
LEFT JOIN (SELECT d.commodity, e.event, arg_min(d.date, (d.price, d.date)) AS date, MIN(d.price) AS price
           FROM daily d, ev e WHERE d.date >= e.event_date GROUP BY 1, 2) m
  ON s.commodity = m.commodity AND s.event = m.event""",
    [("daily", "SELECT commodity, date, AVG(modal_price) AS price FROM price_panel GROUP BY 1, 2"),
     ("ev", f"SELECT * FROM (VALUES {_EV_SQL}) t(event, event_date)")]))
def q_event_study(spark, sf_dir):
    return _qall(N.event_study(price_panel(spark, sf_dir), _events(spark)))


@register("monday_vs_friday", "N7 A3 A17", sql=with_views(["price_panel"], f"""
SELECT commodity, {sq4('m')} AS monday_mean, {sq4('f')} AS friday_mean, {sq4('mm')} AS monday_median, {sq4('fm')} AS friday_median,
  monday_count, friday_count, CASE WHEN m > f THEN 'Monday' ELSE 'Friday' END AS best_day,
  {sq4('GREATEST(m, f) - LEAST(m, f)')} AS price_difference,
  {sq4('((GREATEST(m, f) - LEAST(m, f)) * 100) / NULLIF(LEAST(m, f), 0)')} AS difference_pct
FROM (SELECT commodity, AVG(modal_price) FILTER (WHERE isodow(date) = 1) AS m, AVG(modal_price) FILTER (WHERE isodow(date) = 5) AS f,
        quantile_cont(modal_price, 0.5) FILTER (WHERE isodow(date) = 1) AS mm, quantile_cont(modal_price, 0.5) FILTER (WHERE isodow(date) = 5) AS fm,
        CAST(COUNT(modal_price) FILTER (WHERE isodow(date) = 1) AS BIGINT) AS monday_count,
        CAST(COUNT(modal_price) FILTER (WHERE isodow(date) = 5) AS BIGINT) AS friday_count
      FROM price_panel WHERE isodow(date) IN (1, 5) GROUP BY 1)"""))
def q_monday_vs_friday(spark, sf_dir):
    return _qall(N.monday_vs_friday(price_panel(spark, sf_dir)))


MONTHLY_COST = """
SELECT m.commodity, m.month_start, m.average_monthly_price, c.cost, m.average_monthly_price < c.cost AS below_cost
FROM (SELECT commodity, CAST(date_trunc('month', date) AS DATE) AS month_start, AVG(modal_price) AS average_monthly_price
      FROM price_panel GROUP BY 1, 2) m LEFT JOIN cost_dim c ON m.commodity = c.commodity"""


@register("below_cost_summary", "N8 J4 A14 S9", sql=with_views(["price_panel", "cost_dim"], f"""
SELECT commodity, total_months, months_below_cost, total_months - months_below_cost AS months_above_or_equal_cost,
  {sq4('(months_below_cost * 100.0::DOUBLE) / NULLIF(total_months, 0)')} AS below_cost_pct,
  commodity = (SELECT arg_min(commodity, (-months_below_cost, commodity)) FROM g) AS is_worst
FROM g""", [("monthly_cost", MONTHLY_COST),
            ("g", "SELECT commodity, CAST(COUNT(month_start) AS BIGINT) AS total_months, CAST(COUNT(*) FILTER (WHERE below_cost) AS BIGINT) AS months_below_cost FROM monthly_cost GROUP BY 1")]))
def q_below_cost_summary(spark, sf_dir):
    return _qall(N.below_cost_summary(price_panel(spark, sf_dir), cost_dim(spark)))


@register("months_below_cost", "N8 P2 L1", sql=with_views(["price_panel", "cost_dim"], f"""
SELECT commodity, strftime(month_start, '%Y-%m') AS year_month, {sq4('average_monthly_price')} AS average_monthly_price, {sq4('cost')} AS cost
FROM monthly_cost WHERE below_cost""", [("monthly_cost", MONTHLY_COST)]))
def q_months_below_cost(spark, sf_dir):
    m = N.monthly_vs_cost(price_panel(spark, sf_dir), cost_dim(spark)).filter("below_cost")
    return _qall(m.select("commodity", F.date_format("month_start", "yyyy-MM").alias("year_month"),
                          "average_monthly_price", "cost").orderBy("commodity", "year_month"))


@register("volatility_ranking", "N11 A6 A5", sql=with_views(["price_panel"], f"""
SELECT commodity, {sq4('AVG(modal_price)')} AS mean_price, {sq4('stddev_samp(modal_price)')} AS std_price,
       {sq4('(stddev_samp(modal_price) * 100) / NULLIF(AVG(modal_price), 0)')} AS cv_pct
FROM price_panel GROUP BY 1"""))
def q_volatility_ranking(spark, sf_dir):
    return _qall(N.volatility_ranking(price_panel(spark, sf_dir)).orderBy(F.desc("cv_pct")))


SEASON_SQL = """CASE WHEN month(date) IN (11, 12, 1, 2) THEN 'Winter' WHEN month(date) IN (3, 4, 5) THEN 'Summer'
  WHEN month(date) IN (6, 7, 8, 9) THEN 'Monsoon' ELSE 'Post-Monsoon' END"""


@register("season_means", "N12 A1", sql=with_views(["price_panel"], f"""
SELECT commodity, {SEASON_SQL} AS season, {sq4('AVG(modal_price)')} AS average_price FROM price_panel GROUP BY 1, 2"""))
def q_season_means(spark, sf_dir):
    return _qall(N.season_means(price_panel(spark, sf_dir)))


@register("season_extremes", "N12 A22", sql=with_views(["price_panel"], f"""
SELECT commodity, arg_min(season, (-average_price, o)) AS highest_price_season, {sq4('MAX(average_price)')} AS highest_price,
       arg_min(season, (average_price, o)) AS lowest_price_season, {sq4('MIN(average_price)')} AS lowest_price
FROM (SELECT commodity, season, AVG(modal_price) AS average_price,
        list_position(['Winter', 'Summer', 'Monsoon', 'Post-Monsoon'], season) AS o
      FROM (SELECT *, {SEASON_SQL} AS season FROM price_panel) GROUP BY 1, 2)
GROUP BY 1"""))
def q_season_extremes(spark, sf_dir):
    return _qall(N.season_extremes(price_panel(spark, sf_dir)))


def _rel(x):
    return (f"CASE WHEN {x} >= 0.5 THEN 'Strong Positive' WHEN {x} >= 0.2 THEN 'Moderate Positive' "
            f"WHEN {x} > -0.2 THEN 'Weak Relationship' WHEN {x} > -0.5 THEN 'Moderate Negative' ELSE 'Strong Negative' END")


@register("weather_price_correlation", "N13 N14 A7 A19 A22", sql=with_views(["panel_wx"], f"""
SELECT w.commodity, w.measure, {sq4('w.correlation')} AS correlation, {_rel('w.correlation')} AS relationship,
       COALESCE(w.commodity = b.best, false) AS is_strongest
FROM wc w LEFT JOIN (SELECT measure, arg_min(commodity, (-abs(correlation), commodity)) FILTER (WHERE correlation IS NOT NULL) AS best
                     FROM wc GROUP BY 1) b ON w.measure = b.measure""", [("wc", f"""
  SELECT commodity, 'rainfall' AS measure, {corr_sql('rainfall_mm', 'modal_price')} AS correlation FROM panel_wx GROUP BY 1
  UNION ALL SELECT commodity, 'max_temperature', {corr_sql('max_temp', 'modal_price')} FROM panel_wx GROUP BY 1
  UNION ALL SELECT commodity, 'min_temperature', {corr_sql('min_temp', 'modal_price')} FROM panel_wx GROUP BY 1""")]))
def q_weather_price_correlation(spark, sf_dir):
    """Per measure: correlation, 5-level label and the strongest commodity."""
    wc = N.weather_correlations(panel_with_weather(spark, sf_dir))
    return _qall(N.flag_strongest(wc, "correlation", within=["measure"]))


@register("festival_vs_normal_day", "N15 A18 J2 P12 S9 A22", sql=with_views(["panel_wx", "calendar"], f"""
SELECT commodity, {sq4('n')} AS normal_day_price, {sq4('f')} AS festival_holiday_price, {sq4('f - n')} AS price_difference,
       {sq4('dp')} AS difference_pct,
       COALESCE(commodity = (SELECT arg_min(commodity, (-abs(dp), commodity)) FILTER (WHERE dp IS NOT NULL) FROM
         (SELECT commodity, ((f - n) * 100) / NULLIF(n, 0) AS dp FROM fv)), false) AS is_strongest
FROM (SELECT *, ((f - n) * 100) / NULLIF(n, 0) AS dp FROM fv)""", [("fv", """SELECT * FROM (SELECT commodity, AVG(modal_price) FILTER (WHERE NOT ev) AS n, AVG(modal_price) FILTER (WHERE ev) AS f
      FROM (SELECT p.commodity, p.modal_price,
              (trim(coalesce(c.festival, 'No Festival')) <> 'No Festival' OR coalesce(c.holiday, 0) = 1) AS ev
            FROM panel_wx p LEFT JOIN (SELECT date, string_agg(festival, ' / ' ORDER BY festival) AS festival, MAX(holiday) AS holiday
                                       FROM calendar GROUP BY 1) c ON p.date = c.date)
      GROUP BY 1)""")]))
def q_festival_vs_normal_day(spark, sf_dir):
    e = N.event_day_prices(feature_panel(spark, sf_dir))
    return _qall(N.flag_strongest(e, "difference_pct"))


@register("district_price_extremes", "N16 A1 A22", sql=with_views(["price_panel"], f"""
SELECT commodity, arg_min(district, (-average_price, district)) AS highest_price_district, {sq4('MAX(average_price)')} AS highest_average_price,
  arg_min(district, (average_price, district)) AS lowest_price_district, {sq4('MIN(average_price)')} AS lowest_average_price,
  {sq4('MAX(average_price) - MIN(average_price)')} AS price_gap,
  {sq4('((MAX(average_price) - MIN(average_price)) * 100) / NULLIF(MIN(average_price), 0)')} AS price_gap_pct
FROM (SELECT commodity, district, AVG(modal_price) AS average_price FROM price_panel GROUP BY 1, 2) GROUP BY 1"""))
def q_district_price_extremes(spark, sf_dir):
    return _qall(N.district_extremes(price_panel(spark, sf_dir)))


def _flyc_sql(value, zero_base=False, flag=False):
    pctx = f"((l - f) * 100) / NULLIF(f, 0)"
    if zero_base:
        pctx = f"CASE WHEN f = 0 THEN 0.0::DOUBLE ELSE {pctx} END"
    flag_col = ""
    if flag:
        flag_col = (f", COALESCE(commodity = (SELECT arg_min(commodity, (-({pctx}), commodity)) FILTER (WHERE ({pctx}) IS NOT NULL) "
                    f"FROM yc), false) AS is_highest_increase")
    body = f"""
SELECT commodity, first_year, last_year, {sq4('f')} AS first_year_value, {sq4('l')} AS last_year_value,
       {sq4('l - f')} AS absolute_change, {sq4(pctx)} AS percentage_change{flag_col}
FROM yc"""
    return with_views(["price_panel"], body, [("yc", f"""SELECT * FROM (SELECT y.commodity, b.first_year, b.last_year,
        MAX(avg) FILTER (WHERE year = b.first_year) AS f, MAX(avg) FILTER (WHERE year = b.last_year) AS l
      FROM (SELECT commodity, CAST(year(date) AS INTEGER) AS year, AVG({value}) AS avg FROM price_panel GROUP BY 1, 2) y,
           (SELECT CAST(MIN(year(date)) AS INTEGER) AS first_year, CAST(MAX(year(date)) AS INTEGER) AS last_year FROM price_panel) b
      GROUP BY 1, 2, 3)
WHERE f IS NOT NULL AND l IS NOT NULL""")])


@register("yearly_price_change", "N17 J5 A17 A22", sql=_flyc_sql("modal_price", flag=True))
def q_yearly_price_change(spark, sf_dir):
    y = N.first_last_year_change(price_panel(spark, sf_dir), "modal_price")
    return _qall(N.flag_extreme(y, "percentage_change", "is_highest_increase"))


@register("yearly_arrival_change", "N19 J5", sql=_flyc_sql("arrival", zero_base=True))
def q_yearly_arrival_change(spark, sf_dir):
    return _qall(N.first_last_year_change(price_panel(spark, sf_dir), "arrival", zero_base_pct=0.0))


@register("yearly_price_table", "N17 A1", sql=with_views(["price_panel"], f"""
SELECT commodity, CAST(year(date) AS INTEGER) AS year, {sq4('AVG(modal_price)')} AS average_price FROM price_panel GROUP BY 1, 2"""))
def q_yearly_price_table(spark, sf_dir):
    p = price_panel(spark, sf_dir)
    return p.groupBy("commodity", F.year("date").alias("year")).agg(q4(F.avg("modal_price")).alias("average_price"))


@register("price_momentum", "N20 W11 A22", sql=with_views(["price_panel"], f"""
SELECT commodity, {sq4('f')} AS first_3_month_avg, {sq4('l')} AS last_3_month_avg, {sq4('l - f')} AS price_change,
  {sq4('cp')} AS change_pct,
  CASE WHEN cp > 5 THEN 'Strong Upward' WHEN cp > 0 THEN 'Upward' WHEN cp < -5 THEN 'Strong Downward'
       WHEN cp < 0 THEN 'Downward' ELSE 'Stable' END AS trend,
  COALESCE(commodity = (SELECT arg_min(commodity, (-cp, commodity)) FILTER (WHERE cp IS NOT NULL) FROM mo), false) AS is_strongest_upward,
  COALESCE(commodity = (SELECT arg_min(commodity, (cp, commodity)) FILTER (WHERE cp IS NOT NULL) FROM mo), false) AS is_strongest_downward
FROM mo""", [("mo", """SELECT *, ((l - f) * 100) / NULLIF(f, 0) AS cp FROM (
      SELECT commodity, AVG(price) FILTER (WHERE ra <= 3) AS f, AVG(price) FILTER (WHERE rd <= 3) AS l
      FROM (SELECT commodity, price, row_number() OVER (PARTITION BY commodity ORDER BY m) AS ra,
                   row_number() OVER (PARTITION BY commodity ORDER BY m DESC) AS rd
            FROM (SELECT commodity, date_trunc('month', date) AS m, AVG(modal_price) AS price FROM price_panel GROUP BY 1, 2))
      GROUP BY 1)""")]))
def q_price_momentum(spark, sf_dir):
    m = N.momentum(price_panel(spark, sf_dir))
    m = N.flag_extreme(m, "change_pct", "is_strongest_upward", largest=True)
    return _qall(N.flag_extreme(m, "change_pct", "is_strongest_downward", largest=False))


SHOCK_ROWS = """
SELECT *, coalesce(abs(dpc) >= 20, false) AS price_shock FROM (
  SELECT *, (modal_price / NULLIF(lag(modal_price) OVER (PARTITION BY commodity, district ORDER BY date), 0) - 1) * 100 AS dpc
  FROM price_panel)"""


@register("shock_summary", "N21 A14", sql=with_views(["price_panel"], f"""
SELECT commodity, CAST(COUNT(modal_price) AS BIGINT) AS total_observations, CAST(COUNT(*) FILTER (WHERE price_shock) AS BIGINT) AS shock_events,
  {sq4('(COUNT(*) FILTER (WHERE price_shock) * 100.0::DOUBLE) / NULLIF(COUNT(modal_price), 0)')} AS shock_pct
FROM shock_rows GROUP BY 1""", [("shock_rows", SHOCK_ROWS)]))
def q_shock_summary(spark, sf_dir):
    return _qall(N.shock_summary(price_panel(spark, sf_dir)))


def _shock_sql(order):
    return with_views(["price_panel"], f"""
SELECT date, commodity, district, {sq4('modal_price')} AS modal_price, {sq4('dpc')} AS daily_price_change,
  CASE WHEN dpc > 0 THEN 'Price Spike' ELSE 'Price Crash' END AS shock_type
FROM shock_rows WHERE price_shock ORDER BY {order} LIMIT 10""", [("shock_rows", SHOCK_ROWS)])


@register("top_price_crashes", "N21 L2", sql=_shock_sql("dpc, date, commodity, district"))
def q_top_price_crashes(spark, sf_dir):
    e = N.shock_events(price_panel(spark, sf_dir))
    return _qall(e.orderBy("daily_price_change", "date", "commodity", "district").limit(10))


@register("top_price_spikes", "N21 L2", sql=_shock_sql("dpc DESC, date, commodity, district"))
def q_top_price_spikes(spark, sf_dir):
    e = N.shock_events(price_panel(spark, sf_dir))
    return _qall(e.orderBy(F.desc("daily_price_change"), "date", "commodity", "district").limit(10))


def _mm(x, name):
    return (f"CASE WHEN MAX({x}) OVER () = MIN({x}) OVER () THEN 50.0::DOUBLE "
            f"ELSE (({x} - MIN({x}) OVER ()) * 100) / NULLIF(MAX({x}) OVER () - MIN({x}) OVER (), 0) END AS {name}")


@register("risk_ranking", "N22 A6 A21 J5 J6", sql=with_views(["price_panel", "cost_dim"], f"""
SELECT commodity, {sq4('cv_pct')} AS cv_pct, {sq4('below_cost_pct')} AS below_cost_pct, {sq4('shock_pct')} AS shock_pct,
  {sq4('price_change_pct')} AS price_change_pct, {sq4('volatility_risk')} AS volatility_risk, {sq4('below_cost_risk')} AS below_cost_risk,
  {sq4('shock_risk')} AS shock_risk, {sq4('momentum_risk')} AS momentum_risk, {sq4('score')} AS farmer_risk_score,
  CASE WHEN score >= 66 THEN 'High Risk' WHEN score >= 33 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_level
FROM (SELECT *, volatility_risk * 0.30::DOUBLE + below_cost_risk * 0.30::DOUBLE + shock_risk * 0.20::DOUBLE + momentum_risk * 0.20::DOUBLE AS score
      FROM (SELECT *, {_mm('cv_pct', 'volatility_risk')}, {_mm('below_cost_pct', 'below_cost_risk')},
                   {_mm('shock_pct', 'shock_risk')}, {_mm('-price_change_pct', 'momentum_risk')}
            FROM (SELECT v.commodity, v.cv_pct, b.below_cost_pct, s.shock_pct, m.price_change_pct
                  FROM (SELECT commodity, (stddev_samp(modal_price) * 100) / NULLIF(AVG(modal_price), 0) AS cv_pct FROM price_panel GROUP BY 1) v
                  JOIN (SELECT commodity, AVG(CAST(below_cost AS DOUBLE)) * 100 AS below_cost_pct FROM monthly_cost GROUP BY 1) b ON v.commodity = b.commodity
                  JOIN (SELECT commodity, AVG(CAST(price_shock AS DOUBLE)) * 100 AS shock_pct FROM shock_rows GROUP BY 1) s ON v.commodity = s.commodity
                  JOIN (SELECT commodity, percentage_change AS price_change_pct FROM flyc) m ON v.commodity = m.commodity)))""",
    [("monthly_cost", MONTHLY_COST), ("shock_rows", SHOCK_ROWS),
     ("flyc", """
SELECT commodity, ((l - f) * 100) / NULLIF(f, 0) AS percentage_change
FROM (SELECT y.commodity, MAX(avg) FILTER (WHERE year = b.first_year) AS f, MAX(avg) FILTER (WHERE year = b.last_year) AS l
      FROM (SELECT commodity, year(date) AS year, AVG(modal_price) AS avg FROM price_panel GROUP BY 1, 2) y,
           (SELECT MIN(year(date)) AS first_year, MAX(year(date)) AS last_year FROM price_panel) b GROUP BY 1)
WHERE f IS NOT NULL AND l IS NOT NULL""")]))
def q_risk_ranking(spark, sf_dir):
    r = N.risk_ranking(price_panel(spark, sf_dir), cost_dim(spark))
    return _qall(r.select("commodity", "cv_pct", "below_cost_pct", "shock_pct", "price_change_pct",
                          "volatility_risk", "below_cost_risk", "shock_risk", "momentum_risk",
                          "farmer_risk_score", "risk_level").orderBy(F.desc("farmer_risk_score")))
