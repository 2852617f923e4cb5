"""Cleaning queries (P3-P13, P21, P23, N23, J15) on derived raw extracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.functions import q4
from pricelens.operators import clean as C
from pricelens.operators.panel import panel_with_weather
from pricelens.operators.windows import fill_within_keys
from pricelens.plans.registry import register
from pricelens.plans.sqlviews import q4 as sq4, with_views
from pricelens.sources.raw import legacy_prices, raw_price_strings

RAW_SQL = """
SELECT district AS State, 'Vegetables' AS Commodity_Group, commodity AS Commodity,
  CASE WHEN day(date) = 20 THEN NULL
       WHEN day(date) = 29 THEN '31-02-' || CAST(year(date) AS VARCHAR)
       ELSE strftime(date, '%d-%m-%Y') END AS Date,
  format('{:,.2f}', arrival) AS Arrival, 'Tonnes' AS Arrival_Unit,
  CASE WHEN day(date) = 15 THEN 'NR' ELSE format('{:,.2f}', modal_price) END AS Modal_Price,
  'Rs./Quintal' AS Price_Unit, date AS _d, arrival AS _arr
FROM price_panel"""

RAW_ALL_SQL = """
SELECT State, Commodity_Group, Commodity, Date, Arrival, Arrival_Unit, Modal_Price, Price_Unit FROM raw_base
UNION ALL
SELECT State, Commodity_Group, Commodity, Date, Arrival, Arrival_Unit, Modal_Price, Price_Unit FROM raw_base WHERE day(_d) = 1
UNION ALL
SELECT State, Commodity_Group, Commodity, Date, format('{:,.2f}', _arr + 1.0::DOUBLE), 'Tonnes (revised)', Modal_Price, Price_Unit
FROM raw_base WHERE day(_d) = 10
UNION ALL
SELECT 'State/UT', 'Commodity Group', 'Commodity', 'Date', 'Arrival', 'Unit', 'Modal Price', 'Unit'
FROM (SELECT DISTINCT district, commodity FROM price_panel)
UNION ALL
SELECT 'Note: prices are indicative', NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM (SELECT DISTINCT district, commodity FROM price_panel)
UNION ALL
SELECT 'Weighted average ' || commodity, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM (SELECT DISTINCT district, commodity FROM price_panel)"""

RAW_CTES = [("raw_base", RAW_SQL), ("raw_prices", RAW_ALL_SQL)]

TRIM_SQL = """
SELECT * FROM raw_prices
WHERE NOT (State IS NOT DISTINCT FROM 'State/UT') AND NOT (Date IS NOT DISTINCT FROM 'Date')
  AND NOT (starts_with(coalesce(State, ''), 'Note') OR starts_with(coalesce(State, ''), 'Weighted'))"""

TYPED_SQL = """
SELECT State AS state, Commodity_Group AS commodity_group, Commodity AS commodity,
  CAST(try_strptime(Date, '%d-%m-%Y') AS DATE) AS date,
  TRY_CAST(replace(Arrival, ',', '') AS DOUBLE) AS arrival, Arrival_Unit AS arrival_unit,
  TRY_CAST(replace(Modal_Price, ',', '') AS DOUBLE) AS modal_price, Price_Unit AS price_unit
FROM raw_trim"""

CLEAN_SQL = """
SELECT DISTINCT * FROM raw_typed
WHERE state IS NOT NULL AND commodity_group IS NOT NULL AND commodity IS NOT NULL AND date IS NOT NULL
  AND arrival IS NOT NULL AND arrival_unit IS NOT NULL AND modal_price IS NOT NULL AND price_unit IS NOT NULL"""

CLEAN_CTES = RAW_CTES + [("raw_trim", TRIM_SQL), ("raw_typed", TYPED_SQL), ("clean", CLEAN_SQL)]


def _clean(spark, sf_dir):
    return C.clean_raw_prices(raw_price_strings(spark, sf_dir))


def _qcols(df, names):
    return df.select(*[q4(c).alias(c) if c in names else F.col(c) for c in df.columns])


@register("clean_raw_prices", "S4 S5 P3 P4 P5 P6 P7 P8",
          sql=with_views(["price_panel"], f"""
SELECT state, commodity_group, commodity, date, {sq4('arrival')} AS arrival, arrival_unit,
       {sq4('modal_price')} AS modal_price, price_unit FROM clean""", CLEAN_CTES))
def q_clean_raw_prices(spark, sf_dir):
    return _qcols(_clean(spark, sf_dir), {"arrival", "modal_price"})


@register("parse_failures", "P23 P3 P4", sql=with_views(["price_panel"], """
SELECT CAST(COUNT(*) AS BIGINT) AS rows_after_trim,
       CAST(COUNT(*) FILTER (WHERE Date IS NULL) AS BIGINT) AS null_dates,
       CAST(COUNT(*) FILTER (WHERE Date IS NOT NULL AND try_strptime(Date, '%d-%m-%Y') IS NULL) AS BIGINT) AS bad_dates,
       CAST(COUNT(*) FILTER (WHERE TRY_CAST(replace(Arrival, ',', '') AS DOUBLE) IS NULL) AS BIGINT) AS bad_arrivals,
       CAST(COUNT(*) FILTER (WHERE TRY_CAST(replace(Modal_Price, ',', '') AS DOUBLE) IS NULL) AS BIGINT) AS bad_prices
FROM raw_trim""", RAW_CTES + [("raw_trim", TRIM_SQL)]))
def q_parse_failures(spark, sf_dir):
    raw = raw_price_strings(spark, sf_dir)
    t = C.drop_footer_rows(C.drop_header_rows(raw, {"State": "State/UT", "Date": "Date"}),
                           "State", ("Note", "Weighted"))
    return t.agg(F.count(F.lit(1)).alias("rows_after_trim"),
                 F.count_if(F.col("Date").isNull()).alias("null_dates"),
                 F.count_if(F.col("Date").isNotNull() & C.parse_date("Date").isNull()).alias("bad_dates"),
                 F.count_if(C.parse_number("Arrival").isNull()).alias("bad_arrivals"),
                 F.count_if(C.parse_number("Modal_Price").isNull()).alias("bad_prices"))


@register("raw_load_quality", "N23 P8 P21 J15 A12", sql=with_views(["price_panel"], """
SELECT t.state, t.commodity, CAST(COUNT(*) AS BIGINT) AS rows_loaded,
       MIN(t.date) AS first_date, MAX(t.date) AS last_date,
       CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM raw_typed u
                        WHERE u.state = t.state AND u.commodity = t.commodity)) AS BIGINT) AS duplicate_rows,
       CAST(COUNT(*) FILTER (WHERE t.date IS NULL) AS BIGINT) AS null_dates,
       CAST(COUNT(*) FILTER (WHERE t.modal_price IS NULL) AS BIGINT) AS null_prices,
       CAST(datediff('day', MIN(t.date), MAX(t.date)) + 1 - COUNT(DISTINCT t.date) AS BIGINT) AS missing_dates
FROM raw_typed t GROUP BY t.state, t.commodity""", CLEAN_CTES))
def q_raw_load_quality(spark, sf_dir):
    raw = raw_price_strings(spark, sf_dir)
    t = C.drop_footer_rows(C.drop_header_rows(raw, {"State": "State/UT", "Date": "Date"}),
                           "State", ("Note", "Weighted"))
    typed = t.select(F.col("State").alias("state"), F.col("Commodity").alias("commodity"),
                     F.col("Commodity_Group").alias("commodity_group"),
                     C.parse_date("Date").alias("date"), C.parse_number("Arrival").alias("arrival"),
                     F.col("Arrival_Unit").alias("arrival_unit"),
                     C.parse_number("Modal_Price").alias("modal_price"),
                     F.col("Price_Unit").alias("price_unit"))
    # exact duplicates: count copies per full row first (one shuffle), then roll up per key
    per_row = typed.groupBy(*typed.columns).agg(F.count(F.lit(1)).alias("_copies"))
    dups = per_row.groupBy("state", "commodity").agg(F.sum(F.col("_copies") - 1).alias("duplicate_rows"))
    stats = typed.groupBy("state", "commodity").agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.min("date").alias("first_date"),
        F.max("date").alias("last_date"), F.count_if(F.col("date").isNull()).alias("null_dates"),
        F.count_if(F.col("modal_price").isNull()).alias("null_prices"),
        (F.datediff(F.max("date"), F.min("date")) + 1 - F.count_distinct("date")).cast("long").alias("missing_dates"))
    return (stats.join(dups, ["state", "commodity"])
                 .select("state", "commodity", "rows_loaded", "first_date", "last_date",
                         F.col("duplicate_rows").cast("long").alias("duplicate_rows"),
                         "null_dates", "null_prices", "missing_dates"))


KEY = ["commodity", "state", "date"]
ORDER_SQL = "(arrival_unit = 'Tonnes (revised)'), arrival"


def _key_order():
    return [(F.col("arrival_unit") == "Tonnes (revised)").asc(), F.col("arrival").asc()]


@register("key_dedupe_keep_first", "P9 W12", sql=with_views(["price_panel"], f"""
SELECT state, commodity_group, commodity, date, {sq4('arrival')} AS arrival, arrival_unit,
       {sq4('modal_price')} AS modal_price, price_unit
FROM (SELECT *, row_number() OVER (PARTITION BY commodity, state, date ORDER BY {ORDER_SQL}) AS rn FROM clean)
WHERE rn = 1""", CLEAN_CTES))
def q_key_dedupe(spark, sf_dir):
    return _qcols(C.dedupe_keep_first(_clean(spark, sf_dir), KEY, _key_order()),
                  {"arrival", "modal_price"})


@register("key_dedupe_audit", "P9", sql=with_views(["price_panel"], f"""
SELECT commodity, state, date, {sq4('arrival')} AS arrival, arrival_unit, copies, rank_in_key, rank_in_key = 1 AS kept
FROM (SELECT *, CAST(COUNT(*) OVER (PARTITION BY commodity, state, date) AS BIGINT) AS copies,
             CAST(row_number() OVER (PARTITION BY commodity, state, date ORDER BY {ORDER_SQL}) AS INTEGER) AS rank_in_key
      FROM clean)
WHERE copies > 1""", CLEAN_CTES))
def q_key_dedupe_audit(spark, sf_dir):
    a = C.duplicate_key_audit(_clean(spark, sf_dir), KEY, _key_order())
    return a.select("commodity", "state", "date", q4("arrival").alias("arrival"), "arrival_unit",
                    "copies", "rank_in_key", "kept")


@register("duplicate_key_report", "P10", sql=with_views(["price_panel"], """
SELECT commodity, state, date, CAST(COUNT(*) AS BIGINT) AS copies FROM clean
GROUP BY commodity, state, date HAVING COUNT(*) > 1""", CLEAN_CTES))
def q_duplicate_key_report(spark, sf_dir):
    return C.duplicate_key_report(_clean(spark, sf_dir), KEY)


@register("legacy_price_validity", "P11 P1 P4", sql=with_views([], f"""
SELECT commodity, CAST(t AS DATE) AS date, {sq4('p_min')} AS p_min, {sq4('p_modal')} AS p_modal, {sq4('p_max')} AS p_max
FROM (SELECT p.p_type AS commodity, strftime(CAST(l.l_shipdate AS DATE), '%Y-%m-%d') AS t,
             MIN(l.l_extendedprice / NULLIF(l.l_quantity, 0)) AS p_min,
             MAX(l.l_extendedprice / NULLIF(l.l_quantity, 0)) AS p_max,
             CASE WHEN COUNT(*) > 1 THEN AVG(l.l_extendedprice / NULLIF(l.l_quantity, 0)) * 0.97::DOUBLE END AS p_modal
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
      JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
      GROUP BY 1, 2)
WHERE p_min <= p_modal AND p_modal <= p_max"""))
def q_legacy_price_validity(spark, sf_dir):
    lp = legacy_prices(spark, sf_dir).filter(C.price_order_valid())
    return lp.select("commodity", F.to_date("t").alias("date"), q4("p_min").alias("p_min"),
                     q4("p_modal").alias("p_modal"), q4("p_max").alias("p_max"))


WX = ["max_temp", "min_temp", "rainfall_mm", "wind"]


@register("weather_fill_within_keys", "P13 X12 J1", sql=with_views(["panel_wx"], f"""
SELECT commodity, district, date,
  {', '.join(sq4(f"coalesce(first_value({c} IGNORE NULLS) OVER (PARTITION BY commodity, district ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value({c} IGNORE NULLS) OVER (PARTITION BY commodity, district ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))") + f' AS {c}' for c in WX)}
FROM panel_wx"""))
def q_weather_fill(spark, sf_dir):
    p = panel_with_weather(spark, sf_dir).select("commodity", "district", "date", *WX)
    f = fill_within_keys(p, WX, ("commodity", "district"), "date")
    return _qcols(f, set(WX))


@register("missing_profile", "P21", sql=with_views(["panel_wx"], """
SELECT column_name, CAST(missing AS BIGINT) AS missing, CAST(n AS BIGINT) AS rows FROM (
  SELECT COUNT(*) AS n,
    COUNT(*) FILTER (WHERE commodity IS NULL) AS commodity, COUNT(*) FILTER (WHERE district IS NULL) AS district,
    COUNT(*) FILTER (WHERE date IS NULL) AS date, COUNT(*) FILTER (WHERE modal_price IS NULL) AS modal_price,
    COUNT(*) FILTER (WHERE arrival IS NULL) AS arrival, COUNT(*) FILTER (WHERE max_temp IS NULL) AS max_temp,
    COUNT(*) FILTER (WHERE min_temp IS NULL) AS min_temp, COUNT(*) FILTER (WHERE rainfall_mm IS NULL) AS rainfall_mm,
    COUNT(*) FILTER (WHERE wind IS NULL) AS wind FROM panel_wx)
UNPIVOT (missing FOR column_name IN (commodity, district, date, modal_price, arrival, max_temp, min_temp, rainfall_mm, wind))"""))
def q_missing_profile(spark, sf_dir):
    p = panel_with_weather(spark, sf_dir)
    return C.missing_profile(p, ["commodity", "district", "date", "modal_price", "arrival", *WX])


@register("missing_calendar_dates", "J15 U3", sql=with_views(["price_panel"], """
SELECT a.commodity, a.district, a.date FROM alld a
WHERE NOT EXISTS (SELECT 1 FROM price_panel p WHERE p.commodity = a.commodity AND p.district = a.district AND p.date = a.date)""",
    [("bounds", "SELECT commodity, district, MIN(date) AS d0, MAX(date) AS d1 FROM price_panel GROUP BY 1, 2"),
     ("alld", "SELECT commodity, district, CAST(UNNEST(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds")]))
def q_missing_calendar_dates(spark, sf_dir):
    from pricelens.operators.joins import missing_dates
    from pricelens.sources.adapter import price_panel
    return missing_dates(price_panel(spark, sf_dir), ("commodity", "district"), "date")


@register("csv_ingest_roundtrip", "S1 S2 S3 S4 S5 S6 P5-P8 U1", sql=with_views(["price_panel"], f"""
SELECT state, commodity_group, commodity, date, {sq4('arrival')} AS arrival, arrival_unit,
       {sq4('modal_price')} AS modal_price, price_unit FROM clean""", CLEAN_CTES))
def q_csv_ingest_roundtrip(spark, sf_dir):
    """Land the raw extract as four CSV files (S6), read them back by glob
    and by explicit file list with file lineage (S3) using the positional
    all-string schema without header promotion (S4, S5), then clean."""
    import uuid

    from pricelens.session import checkpoint_dir
    from pricelens.sources.raw import RAW_PRICE_SCHEMA, read_csv
    path = f"{checkpoint_dir(spark).rstrip('/')}/pricelens_landing/{uuid.uuid4().hex}"
    raw_price_strings(spark, sf_dir).repartition(4).write.option("header", True).csv(path)
    by_glob = read_csv(spark, f"{path}/*.csv", RAW_PRICE_SCHEMA, header=False)
    files = [r.f for r in by_glob.select(F.col("_metadata.file_path").alias("f")).distinct().collect()]
    by_list = read_csv(spark, files, RAW_PRICE_SCHEMA, header=False, lineage=True)
    if by_list.select("source_file").distinct().count() != len(files):  # lineage check (S3)
        raise ValueError("file lineage lost")
    return _qcols(C.clean_raw_prices(by_glob), {"arrival", "modal_price"})
