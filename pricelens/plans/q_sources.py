"""Source-format queries: HTML price tables (S8), weather JSON payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.functions import q4
from pricelens.plans.registry import register
from pricelens.plans.sqlviews import q4 as sq4, with_views
from pricelens.sources import raw as RW
from pricelens.sources.adapter import daily_signal, price_panel
from pricelens.sources.tables import read_table

_TR = r"(?s)<tr[^>]*>(.*?)</tr>"
_TD = r"(?s)<td[^>]*>(.*?)</td>"


def price_table_pages(spark, sf_dir):
    """Landed HTML pages, one per (commodity, district, year): a header row and
    one ``<tr>`` per trading day in date order (page size <= 366 rows)."""
    p = price_panel(spark, sf_dir)
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    row = F.concat(F.lit("<tr>"), cell(F.col("district")), cell(F.lit("Vegetables")), cell(F.col("commodity")),
                   cell(F.date_format("date", "dd-MM-yyyy")), cell(F.format_number("arrival", 2)),
                   cell(F.lit("Tonnes")), cell(F.format_number("modal_price", 2)), cell(F.lit("Rs./Quintal")),
                   F.lit("</tr>"))
    rows = p.select("commodity", "district", F.year("date").alias("year"), "date", row.alias("tr"))
    header = "<tr>" + "".join(f"<th>{c}</th>" for c in RW.RAW_PRICE_COLUMNS) + "</tr>"
    pages = rows.groupBy("commodity", "district", "year").agg(
        F.array_sort(F.collect_list(F.struct("date", "tr"))).alias("_rows"))
    html = F.concat(F.lit("<html><body><table>" + header),
                    F.array_join(F.transform("_rows", lambda s: s["tr"]), ""), F.lit("</table></body></html>"))
    return pages.select(F.concat_ws("/", "commodity", "district", F.col("year").cast("string")).alias("page"),
                        html.alias("html"))


@register("html_price_table_rows", "S8 S5 P5", sql=with_views(["price_panel"], """
SELECT commodity || '/' || district || '/' || CAST(year(date) AS VARCHAR) AS page,
       CAST(row_number() OVER (PARTITION BY commodity, district, year(date) ORDER BY date) AS INTEGER) AS row_no,
       district AS State, 'Vegetables' AS Commodity_Group, commodity AS Commodity, strftime(date, '%d-%m-%Y') AS Date,
       format('{:,.2f}', arrival) AS Arrival, 'Tonnes' AS Arrival_Unit, format('{:,.2f}', modal_price) AS Modal_Price,
       'Rs./Quintal' AS Price_Unit
FROM price_panel"""))
def q_html_price_table_rows(spark, sf_dir):
    return RW.html_table_rows(price_table_pages(spark, sf_dir))


@register("pages_table_rows", "S8", sql=with_views([], f"""
SELECT page_id, CAST(row_no AS INTEGER) AS row_no, cells[1] AS c0, cells[2] AS c1, cells[3] AS c2
FROM (SELECT page_id, row_no, list_transform(regexp_extract_all(tr, '{_TD}', 1), lambda c: trim(regexp_replace(c, '<[^>]+>', '', 'g'))) AS cells
      FROM (SELECT page_id, UNNEST(regexp_extract_all(html, '{_TR}', 1)) AS tr,
                   UNNEST(range(len(regexp_extract_all(html, '{_TR}', 1)))) AS row_no FROM pages))
WHERE len(cells) >= 1"""))
def q_pages_table_rows(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages", ["page_id", "html"])
    return RW.html_table_rows(pages, "html", ncols=3)


@register("weather_payload_rows", "S7", sql=with_views(["daily_signal"], f"""
SELECT date, district, {sq4('max_temp')} AS max_temp, {sq4('min_temp')} AS min_temp, {sq4('rainfall_mm')} AS rainfall_mm,
       {sq4('rainfall_mm')} AS rain_mm, {sq4('wind')} AS wind FROM daily_signal"""))
def q_weather_payload_rows(spark, sf_dir):
    """Daily signal -> one JSON payload of parallel arrays per (district, year) -> rows again."""
    d = daily_signal(spark, sf_dir)
    g = d.groupBy("district", F.year("date").alias("year")).agg(
        F.array_sort(F.collect_list(F.struct("date", "max_temp", "min_temp", "rainfall_mm", "wind"))).alias("s"))
    daily = F.struct(F.transform("s", lambda x: F.date_format(x["date"], "yyyy-MM-dd")).alias("time"),
                     F.transform("s", lambda x: x["max_temp"]).alias("temperature_2m_max"),
                     F.transform("s", lambda x: x["min_temp"]).alias("temperature_2m_min"),
                     F.transform("s", lambda x: x["rainfall_mm"]).alias("precipitation_sum"),
                     F.transform("s", lambda x: x["rainfall_mm"]).alias("rain_sum"),
                     F.transform("s", lambda x: x["wind"]).alias("windspeed_10m_max"))
    payload = g.select(F.to_json(F.struct("district", daily.alias("daily"))).alias("json"))
    parsed = payload.select(F.from_json("json", RW.WEATHER_PAYLOAD_SCHEMA).alias("p")).select("p.*")
    rows = RW.weather_payload_rows(parsed)
    return rows.select("date", "district", *[q4(c).alias(c) for c in ["max_temp", "min_temp", "rainfall_mm", "rain_mm", "wind"]])


@register("streaming_price_alerts", "2.11 D1 N21 (stream)", sql=with_views(["price_panel"], f"""
SELECT commodity, district, date AS day, {sq4('modal_price')} AS modal_price, {sq4('arrival')} AS arrival, {sq4('pc')} AS price_change_pct,
  CASE WHEN abs(pc) >= 30 THEN 3 WHEN abs(pc) >= 20 THEN 2 WHEN abs(pc) >= 10 THEN 1 ELSE 0 END AS price_stress,
  CASE WHEN pc >= 20 THEN 'Price Spike' WHEN pc <= -20 THEN 'Price Crash' END AS shock_type
FROM (SELECT *, (modal_price / NULLIF(lag(modal_price) OVER (PARTITION BY commodity, district ORDER BY date), 0) - 1) * 100 AS pc FROM price_panel)"""))
def q_streaming_price_alerts(spark, sf_dir):
    """Lands the price rows by date range, runs the alert stream to completion
    (availableNow) and returns all trading days."""
    import uuid

    from pricelens.session import checkpoint_dir
    from pricelens.sources.store import remove
    from pricelens.streaming.alerts import land_price_rows, run_alerts
    base = f"{checkpoint_dir(spark).rstrip('/')}/pricelens_stream/{uuid.uuid4().hex}"
    land_price_rows(spark, sf_dir, f"{base}/landing")
    out = run_alerts(spark, f"{base}/landing", f"{base}/checkpoint", f"{base}/partials")
    remove(spark, f"{base}/landing")  # the daily partial sums are what is read from here on
    return out.select("commodity", "district", "day", *[q4(c).alias(c) for c in ("modal_price", "arrival", "price_change_pct")], "price_stress", "shock_type")
