"""Join-centric queries (J1 compat, J14, J16) and small cleaning operators
(P14, P16, P19, P22) that need a join or a global aggregate."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.functions import q4
from pricelens.operators.joins import code_map, unseen_categories
from pricelens.operators.panel import join_weather
from pricelens.operators.stats import attach, quantile_table
from pricelens.plans.registry import register
from pricelens.plans.sqlviews import q4 as sq4, with_views
from pricelens.sources.adapter import daily_signal, price_panel


@register("panel_weather_date_only", "J1 (date-only fan-out, compat)", sql=with_views(["price_panel", "daily_signal"], f"""
SELECT p.commodity, p.district, p.date, w.district AS weather_district, {sq4('p.modal_price')} AS modal_price,
       {sq4('w.max_temp')} AS max_temp, {sq4('w.rainfall_mm')} AS rainfall_mm
FROM price_panel p LEFT JOIN daily_signal w ON p.date = w.date"""))
def q_panel_weather_date_only(spark, sf_dir):
    """The reference's join on Date alone: each price row meets every
    district's weather of that day (rows multiply by districts per day)."""
    w = daily_signal(spark, sf_dir).select("date", F.col("district").alias("weather_district"),
                                          "max_temp", "rainfall_mm")
    j = join_weather(price_panel(spark, sf_dir), w, on=("date",))
    return j.select("commodity", "district", "date", "weather_district", q4("modal_price").alias("modal_price"),
                    q4("max_temp").alias("max_temp"), q4("rainfall_mm").alias("rainfall_mm"))


_YEAR_SPLIT = """(SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i FROM (SELECT DISTINCT date FROM price_panel))
        WHERE i = (SELECT floor(COUNT(DISTINCT date) * 0.8) FROM price_panel))"""


@register("unseen_category_years", "J14 U3 M3", sql=with_views(["price_panel"], f"""
SELECT DISTINCT CAST(year(date) AS INTEGER) AS year FROM price_panel WHERE date >= {_YEAR_SPLIT}
EXCEPT SELECT DISTINCT CAST(year(date) AS INTEGER) FROM price_panel WHERE date < {_YEAR_SPLIT}"""))
def q_unseen_category_years(spark, sf_dir):
    """Categories (calendar years) of the test split never seen in training."""
    from pricelens.ml.data import chrono_split
    p = price_panel(spark, sf_dir).withColumn("year", F.year("date"))
    train, test = chrono_split(p, "date_fraction")
    return unseen_categories(train, test, "year")


@register("district_code_map", "J16 M1", sql=with_views(["price_panel", "daily_signal"], """
SELECT w.date, w.district, COALESCE(c.code, -1) AS code
FROM daily_signal w LEFT JOIN (
  SELECT district, CAST(row_number() OVER (ORDER BY district) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT district FROM price_panel WHERE commodity <> 'PROMO' OR district <> 'ASIA')) c
ON w.district = c.district"""))
def q_district_code_map(spark, sf_dir):
    """Alphabetical district codes from the panel, applied to the weather
    table; districts without a code get -1."""
    from pyspark.sql import Window
    labels = (price_panel(spark, sf_dir).filter((F.col("commodity") != "PROMO") | (F.col("district") != "ASIA"))
              .select("district").distinct())
    labels = labels.select("district", (F.row_number().over(Window.orderBy("district")) - 1).cast("int").alias("code"))
    return code_map(daily_signal(spark, sf_dir).select("date", "district"), labels, "district")


@register("median_imputation", "P14 M3", sql=with_views(["panel_wx"], f"""
SELECT p.commodity, p.district, p.date,
  {sq4('COALESCE(p.max_temp, m.mt)')} AS max_temp, {sq4('COALESCE(p.rainfall_mm, m.rf)')} AS rainfall_mm,
  p.max_temp IS NULL AS imputed
FROM panel_wx p, (SELECT quantile_cont(max_temp, 0.5) AS mt, quantile_cont(rainfall_mm, 0.5) AS rf
                  FROM panel_wx WHERE date < {_YEAR_SPLIT.replace('price_panel', 'panel_wx')}) m"""))
def q_median_imputation(spark, sf_dir):
    """Missing weather filled with the medians of the training split only."""
    from pricelens.ml.data import chrono_split
    from pricelens.operators.panel import panel_with_weather
    p = panel_with_weather(spark, sf_dir)
    train, _ = chrono_split(p, "date_fraction")
    med = quantile_table(train, {"_mt": ("max_temp", 0.5), "_rf": ("rainfall_mm", 0.5)})
    j = attach(p, med)
    return j.select("commodity", "district", "date",
                    q4(F.coalesce("max_temp", "_mt")).alias("max_temp"),
                    q4(F.coalesce("rainfall_mm", "_rf")).alias("rainfall_mm"),
                    F.col("max_temp").isNull().alias("imputed"))


@register("case_insensitive_filter", "P16 P17 P18", sql=with_views(["price_panel"], f"""
SELECT district, CAST(COUNT(*) AS BIGINT) AS days, {sq4('AVG(modal_price)')} AS avg_price
FROM price_panel WHERE lower(commodity) = 'standard' AND district IN ('ASIA', 'EUROPE', 'AFRICA')
  AND date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' GROUP BY 1"""))
def q_case_insensitive_filter(spark, sf_dir):
    p = price_panel(spark, sf_dir)
    f = p.filter((F.lower("commodity") == "standard") & F.col("district").isin("ASIA", "EUROPE", "AFRICA")
                 & F.col("date").between(F.lit("1996-01-01").cast("date"), F.lit("1999-12-31").cast("date")))
    return f.groupBy("district").agg(F.count(F.lit(1)).alias("days"), q4(F.avg("modal_price")).alias("avg_price"))


@register("column_identity_check", "P19", sql=with_views(["price_panel"], """
SELECT bool_and(modal_price IS NOT DISTINCT FROM p2) AS price_identical,
       bool_and(arrival IS NOT DISTINCT FROM a2) AS arrival_identical
FROM (SELECT modal_price, modal_price * 1.0::DOUBLE AS p2, arrival, arrival + 0.0::DOUBLE AS a2 FROM price_panel)"""))
def q_column_identity_check(spark, sf_dir):
    """(a == b).all() as ``bool_and(a <=> b)`` in one pass."""
    p = price_panel(spark, sf_dir)
    p = p.withColumns({"p2": F.col("modal_price") * F.lit(1.0), "a2": F.col("arrival") + F.lit(0.0)})
    return p.agg(F.bool_and(F.col("modal_price").eqNullSafe(F.col("p2"))).alias("price_identical"),
                 F.bool_and(F.col("arrival").eqNullSafe(F.col("a2"))).alias("arrival_identical"))


@register("seeded_sample", "P22 (sampling operator)", sql=with_views(["price_panel"], f"""
SELECT commodity, district, date, {sq4('modal_price')} AS modal_price, {sq4('arrival')} AS arrival FROM price_panel
ORDER BY md5(commodity || '|' || district || '|' || strftime(date, '%Y-%m-%d') || '|42'), commodity, district, date LIMIT 500"""))
def q_seeded_sample(spark, sf_dir, n: int = 500, seed: int = 42):
    """Repeatable sample of n (price, arrival) points for a scatter plot:
    order by a seeded hash of the key, keep n (the limit is the feature)."""
    p = price_panel(spark, sf_dir)
    key = F.concat_ws("|", "commodity", "district", F.date_format("date", "yyyy-MM-dd"), F.lit(str(seed)))
    return p.select("commodity", "district", "date", q4("modal_price").alias("modal_price"),
                    q4("arrival").alias("arrival")).orderBy(F.md5(F.encode(key, "UTF-8")), "commodity", "district", "date").limit(n)
