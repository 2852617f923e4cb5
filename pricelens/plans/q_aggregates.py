"""Aggregate queries (A1-A26) over the price panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.functions import q4
from pricelens.functions import safe_corr
from pricelens.operators import aggregates as AG
from pricelens.operators import stats as S
from pricelens.operators.panel import panel_with_weather
from pricelens.operators.windows import add_change_features
from pricelens.plans.registry import register
from pricelens.plans.sqlviews import q4 as sq4, with_views
from pricelens.sources.adapter import price_panel

NUM = ["modal_price", "arrival", "max_temp", "min_temp", "rainfall_mm", "wind"]


def _qc(df, names):
    return df.select(*[q4(c).alias(c) if c in names else F.col(c) for c in df.columns])


def corr_sql(a, b):
    """Guarded pairwise-complete Pearson in DuckDB (NULL when constant)."""
    pa = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a} END"
    pb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {b} END"
    return f"(covar_samp({pa}, {pb}) / NULLIF(stddev_samp({pa}) * stddev_samp({pb}), 0))"


@register("monthly_mean_price", "A1 P18", sql=with_views(["price_panel"], f"""
SELECT commodity, CAST(month(date) AS INTEGER) AS month, {sq4('AVG(modal_price)')} AS avg_price
FROM price_panel GROUP BY 1, 2"""))
def q_monthly_mean_price(spark, sf_dir):
    p = price_panel(spark, sf_dir)
    return p.groupBy("commodity", F.month("date").alias("month")).agg(q4(F.avg("modal_price")).alias("avg_price"))


@register("price_stress_counts", "A2 D1", sql=with_views(["price_panel"], """
SELECT commodity, price_stress, CAST(COUNT(*) AS BIGINT) AS n FROM (
  SELECT commodity,
    CASE WHEN abs(pc) >= 30 THEN 3 WHEN abs(pc) >= 20 THEN 2 WHEN abs(pc) >= 10 THEN 1 ELSE 0 END AS price_stress
  FROM (SELECT commodity, (modal_price / NULLIF(lag(modal_price) OVER (PARTITION BY commodity, district ORDER BY date), 0) - 1) * 100 AS pc
        FROM price_panel))
GROUP BY 1, 2"""))
def q_price_stress_counts(spark, sf_dir):
    from pricelens.operators.scores import price_stress
    f = add_change_features(price_panel(spark, sf_dir))
    return (f.select("commodity", price_stress(F.abs("price_change_pct")).alias("price_stress"))
             .groupBy("commodity", "price_stress").agg(F.count(F.lit(1)).alias("n")))


@register("price_mean_median_count", "A3", sql=with_views(["price_panel"], f"""
SELECT commodity, {sq4('AVG(modal_price)')} AS mean_price, {sq4('quantile_cont(modal_price, 0.5)')} AS median_price,
       CAST(COUNT(modal_price) AS BIGINT) AS n
FROM price_panel GROUP BY 1"""))
def q_price_mean_median_count(spark, sf_dir):
    p = price_panel(spark, sf_dir)
    g = S.agg_with_quantiles(p, ["commodity"], [F.avg("modal_price").alias("mean_price"), F.count("modal_price").alias("n")],
                             {"median_price": ("modal_price", 0.5)})
    return _qc(g, {"mean_price", "median_price"})


PROFILE = [("average_price", "AVG(modal_price)"), ("price_volatility", "stddev_samp(modal_price)"),
           ("average_arrival", "AVG(arrival)"), ("average_max_temp", "AVG(max_temp)"),
           ("average_min_temp", "AVG(min_temp)"), ("average_rainfall", "AVG(rainfall_mm)"),
           ("average_wind", "AVG(wind)")]


def district_profile(df):
    return df.groupBy("district").agg(
        F.avg("modal_price").alias("average_price"), F.stddev_samp("modal_price").alias("price_volatility"),
        F.avg("arrival").alias("average_arrival"), F.avg("max_temp").alias("average_max_temp"),
        F.avg("min_temp").alias("average_min_temp"), F.avg("rainfall_mm").alias("average_rainfall"),
        F.avg("wind").alias("average_wind"))


@register("district_profile", "A4", sql=with_views(["panel_wx"], "SELECT district, " + ", ".join(
    f"{sq4(e)} AS {n}" for n, e in PROFILE) + " FROM panel_wx GROUP BY 1"))
def q_district_profile(spark, sf_dir):
    d = district_profile(panel_with_weather(spark, sf_dir))
    return _qc(d, {n for n, _ in PROFILE})


@register("commodity_price_stats", "A5", sql=with_views(["price_panel"], f"""
SELECT commodity, {sq4('MIN(modal_price)')} AS min_price, {sq4('MAX(modal_price)')} AS max_price,
       {sq4('AVG(modal_price)')} AS mean_price, {sq4('stddev_samp(modal_price)')} AS std_price
FROM price_panel GROUP BY 1"""))
def q_commodity_price_stats(spark, sf_dir):
    p = price_panel(spark, sf_dir)
    return p.groupBy("commodity").agg(q4(F.min("modal_price")).alias("min_price"),
                                      q4(F.max("modal_price")).alias("max_price"),
                                      q4(F.avg("modal_price")).alias("mean_price"),
                                      q4(F.stddev_samp("modal_price")).alias("std_price"))


@register("price_arrival_correlation", "A7 N10 A22", sql=with_views(["price_panel"], f"""
SELECT commodity, {sq4('c')} AS correlation,
  CASE WHEN c > 0.1 THEN 'Positive' WHEN c < -0.1 THEN 'Negative' ELSE 'Weak/None' END AS relationship, n,
  COALESCE(commodity = (SELECT arg_min(commodity, (-abs(c), commodity)) FILTER (WHERE c IS NOT NULL) FROM g), false) AS is_strongest
FROM g""", [("g", f"SELECT commodity, {corr_sql('modal_price', 'arrival')} AS c, CAST(COUNT(*) AS BIGINT) AS n FROM price_panel GROUP BY 1")]))
def q_price_arrival_correlation(spark, sf_dir):
    from pricelens.operators.analyses import flag_strongest
    p = price_panel(spark, sf_dir)
    c = p.groupBy("commodity").agg(safe_corr("modal_price", "arrival").alias("_c"), F.count(F.lit(1)).alias("n"))
    c = flag_strongest(c, "_c")
    return c.select("commodity", q4("_c").alias("correlation"),
                    F.when(F.col("_c") > 0.1, "Positive").when(F.col("_c") < -0.1, "Negative")
                     .otherwise("Weak/None").alias("relationship"), "n", "is_strongest")


def _pairs(cols):
    from itertools import combinations
    return list(combinations(cols, 2))


@register("correlation_matrix", "A8", sql=with_views(["panel_wx"], " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {sq4(corr_sql(a, b))} AS corr FROM panel_wx"
    for a, b in _pairs(NUM))))
def q_correlation_matrix(spark, sf_dir):
    m = S.corr_matrix(panel_with_weather(spark, sf_dir), NUM)
    return m.select("col_a", "col_b", q4("corr").alias("corr"))


@register("district_leadership", "A9 N4 X16", sql=with_views(["price_panel"], f"""
SELECT a.commodity, a.district, {sq4('AVG(c)')} AS leadership_score FROM (
  SELECT x.commodity, x.district AS district, y.district AS other, {corr_sql('x.modal_price', 'y.modal_price')} AS c
  FROM price_panel x JOIN price_panel y ON x.commodity = y.commodity AND x.date = y.date AND x.district <> y.district
  GROUP BY 1, 2, 3) a
GROUP BY 1, 2"""))
def q_district_leadership(spark, sf_dir):
    p = price_panel(spark, sf_dir)
    ls = AG.leadership_scores(p, ("commodity",), "date", "district", "modal_price")
    return ls.select("commodity", "district", q4("leadership_score").alias("leadership_score"))


@register("price_quantiles", "A10 D16", sql=with_views(["price_panel"], f"""
SELECT commodity, {sq4('quantile_cont(modal_price, 0.33)')} AS p33, {sq4('quantile_cont(modal_price, 0.66)')} AS p66,
       {sq4('quantile_cont(modal_price, 0.5)')} AS p50, {sq4('quantile_cont(modal_price, 0.9)')} AS p90
FROM price_panel GROUP BY 1"""))
def q_price_quantiles(spark, sf_dir):
    p = price_panel(spark, sf_dir)
    names = {"p33": 0.33, "p66": 0.66, "p50": 0.5, "p90": 0.9}
    g = S.quantile_columns(p, "modal_price", names, ["commodity"])
    return g.select("commodity", *[q4(n).alias(n) for n in names])


@register("describe_panel", "A13", sql=with_views(["panel_wx"], " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, CAST(COUNT({c}) AS BIGINT) AS count, {sq4(f'AVG({c})')} AS mean, {sq4(f'stddev_samp({c})')} AS std,
  {sq4(f'MIN({c})')} AS min, {sq4(f'quantile_cont({c}, 0.25)')} AS p25, {sq4(f'quantile_cont({c}, 0.5)')} AS p50,
  {sq4(f'quantile_cont({c}, 0.75)')} AS p75, {sq4(f'MAX({c})')} AS max FROM panel_wx""" for c in NUM)))
def q_describe_panel(spark, sf_dir):
    d = S.describe(panel_with_weather(spark, sf_dir), NUM)
    return _qc(d, {"mean", "std", "min", "p25", "p50", "p75", "max"})


@register("dataset_overview", "A12 U4", sql=with_views(["price_panel"], """
SELECT CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(DISTINCT commodity) AS BIGINT) AS commodities,
       CAST(COUNT(DISTINCT district) AS BIGINT) AS districts, CAST(COUNT(DISTINCT date) AS BIGINT) AS dates,
       MIN(date) AS first_date, MAX(date) AS last_date FROM price_panel"""))
def q_dataset_overview(spark, sf_dir):
    p = price_panel(spark, sf_dir)
    return p.agg(F.count(F.lit(1)).alias("rows"), S.distinct_count("commodity").alias("commodities"),
                 S.distinct_count("district").alias("districts"), S.distinct_count("date").alias("dates"),
                 F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@register("shock_ratio", "A14 W9", sql=with_views(["price_panel"], f"""
SELECT commodity, CAST(COUNT(*) FILTER (WHERE abs(pc) >= 20) AS BIGINT) AS shock_days,
       CAST(COUNT(pc) AS BIGINT) AS days_with_change,
       {sq4('100.0::DOUBLE * COUNT(*) FILTER (WHERE abs(pc) >= 20) / NULLIF(COUNT(pc), 0)')} AS shock_rate_pct
FROM (SELECT commodity, (modal_price / NULLIF(lag(modal_price) OVER (PARTITION BY commodity, district ORDER BY date), 0) - 1) * 100 AS pc
      FROM price_panel) GROUP BY 1"""))
def q_shock_ratio(spark, sf_dir):
    f = add_change_features(price_panel(spark, sf_dir))
    g = f.groupBy("commodity").agg(F.count_if(F.abs("price_change_pct") >= 20).alias("shock_days"),
                                   F.count("price_change_pct").alias("days_with_change"))
    return g.withColumn("shock_rate_pct", q4(F.try_divide(F.lit(100.0) * F.col("shock_days"), F.col("days_with_change"))))


@register("first_last_price", "A15 X14", sql=with_views(["price_panel"], f"""
SELECT commodity, {sq4('arg_min(modal_price, date_key)')} AS first_price, {sq4('arg_max(modal_price, date_key)')} AS last_price,
       MIN(date) AS first_date, MAX(date) AS last_date
FROM (SELECT *, strftime(date, '%Y%m%d') || district AS date_key FROM price_panel) GROUP BY 1"""))
def q_first_last_price(spark, sf_dir):
    p = price_panel(spark, sf_dir)
    k = F.struct("date", "district")
    return p.groupBy("commodity").agg(q4(F.min_by("modal_price", k)).alias("first_price"),
                                      q4(F.max_by("modal_price", k)).alias("last_price"),
                                      F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@register("price_histogram", "A23", sql=with_views(["price_panel"], f"""
SELECT commodity, bin, {sq4('lo + (bin - 1) * (hi - lo) / 40.0::DOUBLE')} AS bin_start,
       {sq4('lo + bin * (hi - lo) / 40.0::DOUBLE')} AS bin_end, CAST(COUNT(*) AS BIGINT) AS count
FROM (SELECT p.commodity, b.lo, b.hi,
        CAST(CASE WHEN b.hi = b.lo THEN 1 ELSE LEAST(floor((p.modal_price - b.lo) * 40.0::DOUBLE / (b.hi - b.lo)) + 1, 40) END AS INTEGER) AS bin
      FROM price_panel p JOIN (SELECT commodity, MIN(modal_price) AS lo, MAX(modal_price) AS hi FROM price_panel GROUP BY 1) b
        ON p.commodity = b.commodity WHERE p.modal_price IS NOT NULL)
GROUP BY commodity, bin, lo, hi"""))
def q_price_histogram(spark, sf_dir):
    h = S.histogram(price_panel(spark, sf_dir), "modal_price", 40, ["commodity"])
    return _qc(h, {"bin_start", "bin_end"})


@register("price_box_plot", "A24", sql=with_views(["price_panel"], f"""
SELECT commodity, CAST(COUNT(modal_price) AS BIGINT) AS n, {sq4('quantile_cont(modal_price, 0.0)')} AS min,
  {sq4('quantile_cont(modal_price, 0.25)')} AS q1, {sq4('quantile_cont(modal_price, 0.5)')} AS median,
  {sq4('quantile_cont(modal_price, 0.75)')} AS q3, {sq4('quantile_cont(modal_price, 1.0)')} AS max
FROM price_panel GROUP BY 1"""))
def q_price_box_plot(spark, sf_dir):
    b = S.five_numbers(price_panel(spark, sf_dir), ["commodity"], "modal_price")
    return _qc(b, {"min", "q1", "median", "q3", "max"})


@register("panel_completeness", "A26 A16", sql=with_views(["price_panel"], """
SELECT CAST(COUNT(DISTINCT commodity) AS BIGINT) AS n_commodity, CAST(COUNT(DISTINCT district) AS BIGINT) AS n_district,
       CAST(COUNT(DISTINCT (commodity, district)) AS BIGINT) AS n_pairs,
       COUNT(DISTINCT (commodity, district)) = COUNT(DISTINCT commodity) * COUNT(DISTINCT district) AS complete
FROM price_panel"""))
def q_panel_completeness(spark, sf_dir):
    return AG.completeness(price_panel(spark, sf_dir), "commodity", "district")


@register("weekday_pivot", "A17 P2", sql=with_views(["price_panel"], f"""
SELECT commodity, """ + ", ".join(
    f"{sq4(f'AVG(modal_price) FILTER (WHERE isodow(date) - 1 = {i})')} AS {d}"
    for i, d in enumerate(["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"])) +
    " FROM price_panel GROUP BY 1"))
def q_weekday_pivot(spark, sf_dir):
    p = price_panel(spark, sf_dir).withColumn("_wd", F.weekday("date"))
    names = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    w = AG.pivot_mean(p, ["commodity"], "_wd", "modal_price", list(range(7)))
    return w.select("commodity", *[q4(F.col(str(i))).alias(n) for i, n in enumerate(names)])


_BAND = ("CASE WHEN rainfall_mm IS NULL THEN NULL WHEN rainfall_mm >= 100 THEN 'heavy' "
         "WHEN rainfall_mm >= 50 THEN 'moderate' ELSE 'light' END")


@register("rain_band_counts", "A2 P21", sql=with_views(["panel_wx"], f"""
SELECT district, {_BAND} AS rain_band, CAST(COUNT(*) AS BIGINT) AS count FROM panel_wx GROUP BY 1, 2"""))
def q_rain_band_counts(spark, sf_dir):
    """Value counts of (district, rainfall band) keeping the NULL bucket of
    days without weather (dropna=False)."""
    r = F.col("rainfall_mm")
    band = F.when(r.isNull(), F.lit(None).cast("string")).when(r >= 100, "heavy").when(r >= 50, "moderate") \
        .otherwise("light")
    p = panel_with_weather(spark, sf_dir).select("district", band.alias("rain_band"))
    return AG.value_counts(p, ["district", "rain_band"], dropna=False)
