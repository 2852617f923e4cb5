"""Raw-extract readers and the derived dirty string tables.

File readers declare the schema up front (no inference) and keep the file
name as lineage.  ``raw_price_strings`` / ``legacy_prices`` derive the dirty
string extracts the cleaning operators need from the driver tables, so their
size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.sources.adapter import price_panel, price_rows

# Positional names of the market price extract (fixed values).
RAW_PRICE_COLUMNS = ["State", "Commodity_Group", "Commodity", "Date", "Arrival",
                     "Arrival_Unit", "Modal_Price", "Price_Unit"]
RAW_PRICE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_PRICE_COLUMNS])
HEADER_MARKERS = ("State/UT", "Date")
FOOTER_PREFIXES = ("Note", "Weighted")

WEATHER_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("district", T.StringType()),
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m_max", T.ArrayType(T.DoubleType())),
        T.StructField("temperature_2m_min", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
        T.StructField("rain_sum", T.ArrayType(T.DoubleType())),
        T.StructField("windspeed_10m_max", T.ArrayType(T.DoubleType())),
    ])),
])


# -- file scans ---------------------------------------------------------------
def read_csv(spark: SparkSession, paths, schema: T.StructType | None = None,
             header: bool = True, lineage: bool = False) -> DataFrame:
    """One path, a glob, or a list of files; explicit schema.

    ``header=False`` with the positional raw schema is the banner-row case
    (S4/S5): the header and banner lines arrive as data and are removed by
    ``clean.drop_header_rows``.
    """
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(paths)
    if lineage:
        df = df.withColumn("source_file", F.col("_metadata.file_name"))
    return df


def read_weather_payloads(spark: SparkSession, paths) -> DataFrame:
    """Landed JSON payloads of parallel daily arrays -> one row per (district, date)."""
    raw = spark.read.schema(WEATHER_PAYLOAD_SCHEMA).option("multiLine", True).json(paths)
    return weather_payload_rows(raw)


def weather_payload_rows(raw: DataFrame) -> DataFrame:
    d = raw["daily"]
    z = F.arrays_zip(d["time"].alias("time"), d["temperature_2m_max"].alias("max_temp"),
                     d["temperature_2m_min"].alias("min_temp"),
                     d["precipitation_sum"].alias("rainfall_mm"), d["rain_sum"].alias("rain_mm"),
                     d["windspeed_10m_max"].alias("wind"))
    return (raw.select("district", F.inline(z))
               .select(F.to_date("time").alias("date"), "district", "max_temp", "min_temp",
                       "rainfall_mm", "rain_mm", "wind"))


def html_table_rows(pages: DataFrame, html_col: str = "html", ncols: int = 8) -> DataFrame:
    """Rows of every ``<table>`` in landed HTML pages, one output row per ``<tr>`` with cells.

    Pure SQL string functions: ``regexp_extract_all`` finds rows, then cells;
    header rows (``<th>``) carry no ``<td>`` and drop out.
    """
    tr = F.regexp_extract_all(F.col(html_col), F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), 1)
    rows = pages.select("*", F.posexplode(tr).alias("row_no", "tr"))
    cells = F.regexp_extract_all(F.col("tr"), F.lit(r"(?s)<td[^>]*>(.*?)</td>"), 1)
    rows = rows.withColumn("cells", F.transform(cells, lambda c: F.trim(F.regexp_replace(c, "<[^>]+>", ""))))
    rows = rows.filter(F.size("cells") >= 1)
    return rows.select(*[c for c in pages.columns if c != html_col], "row_no",
                       *[F.element_at("cells", i + 1).alias(RAW_PRICE_COLUMNS[i] if ncols == 8 else f"c{i}")
                         for i in range(ncols)])


# -- derived dirty extracts -----------------------------------------------------
def raw_price_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string market extract as delivered, derived from the price panel.

    Dirty rows, all derived from the data: a repeated header row and two
    footer rows per (district, commodity); an exact duplicate of every
    day-1 row; a revised second row for every day-10 row (same key,
    different arrival); a non-numeric price on day 15; a NULL date on day
    20; an impossible date on day 29 of February-like months (31st shown as
    '31-02').
    """
    p = price_panel(spark, sf_dir)
    day = F.dayofmonth("date")
    base = p.select(
        F.col("district").alias("State"), F.lit("Vegetables").alias("Commodity_Group"),
        F.col("commodity").alias("Commodity"),
        F.when(day == 20, F.lit(None).cast("string"))
         .when(day == 29, F.concat(F.lit("31-02-"), F.year("date").cast("string")))
         .otherwise(F.date_format("date", "dd-MM-yyyy")).alias("Date"),
        F.format_number("arrival", 2).alias("Arrival"),
        F.lit("Tonnes").alias("Arrival_Unit"),
        F.when(day == 15, F.lit("NR")).otherwise(F.format_number("modal_price", 2)).alias("Modal_Price"),
        F.lit("Rs./Quintal").alias("Price_Unit"), F.col("date").alias("_d"),
        F.col("arrival").alias("_arr"))
    dup = base.filter(F.dayofmonth("_d") == 1)
    revised = (base.filter(F.dayofmonth("_d") == 10)
                   .withColumn("Arrival", F.format_number(F.col("_arr") + F.lit(1.0), 2))
                   .withColumn("Arrival_Unit", F.lit("Tonnes (revised)")))
    keys = p.select("district", "commodity").distinct()
    hdr = keys.select(F.lit("State/UT").alias("State"), F.lit("Commodity Group").alias("Commodity_Group"),
                      F.lit("Commodity").alias("Commodity"), F.lit("Date").alias("Date"),
                      F.lit("Arrival").alias("Arrival"), F.lit("Unit").alias("Arrival_Unit"),
                      F.lit("Modal Price").alias("Modal_Price"), F.lit("Unit").alias("Price_Unit"))
    note = keys.select(F.lit("Note: prices are indicative").alias("State"),
                       *[F.lit(None).cast("string").alias(c) for c in RAW_PRICE_COLUMNS[1:]])
    wavg = keys.select(F.concat(F.lit("Weighted average "), F.col("commodity")).alias("State"),
                       *[F.lit(None).cast("string").alias(c) for c in RAW_PRICE_COLUMNS[1:]])
    cols = RAW_PRICE_COLUMNS
    return (base.select(*cols).unionByName(dup.select(*cols)).unionByName(revised.select(*cols))
                .unionByName(hdr).unionByName(note).unionByName(wavg))


def legacy_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(commodity, t, p_min, p_modal, p_max): legacy daily min/modal/max extract.

    ``p_modal`` is the mean discounted unit price, so it can fall below
    ``p_min`` (undiscounted), which the validity filter must catch.
    """
    return (price_rows(spark, sf_dir).groupBy("commodity", "date")
              .agg(F.min("unit_price").alias("p_min"), F.max("unit_price").alias("p_max"),
                   F.avg("unit_price").alias("_avg"), F.count(F.lit(1)).alias("_n"))
              .select("commodity", F.date_format("date", "yyyy-MM-dd").alias("t"), "p_min",
                      # one-line days carry no modal quote (NULL), others a damped mean
                      F.when(F.col("_n") > 1, F.col("_avg") * F.lit(0.97)).alias("p_modal"),
                      "p_max"))
