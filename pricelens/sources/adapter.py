"""Test-data adapter: derive the price-panel inputs from the driver tables.

The reference's own market extracts are not available, so the panel is built
from the TPC-H-like tables with a fixed mapping:

* commodity   = ``part.p_type``
* district    = region name of the supplier (``supplier -> nation -> region``)
* date        = ``lineitem.l_shipdate`` as a date
* modal_price = mean unit price ``l_extendedprice / l_quantity`` of the day
* arrival     = total ``l_quantity`` of the day

``daily_signal`` is a stand-in for district weather built from ``orders`` by
order date x customer region, scaled so every weather-stress branch fires.
``calendar`` is the fixed-date holiday list for every year in the panel.

Scale notes: ``lineitem`` is the only large input.  ``part`` and ``supplier``
grow with the data, so they are joined with whatever strategy Catalyst/AQE
picks from their measured size (broadcast below
``spark.sql.autoBroadcastJoinThreshold``, sort-merge above it, skew split by
AQE).  Only ``nation`` x ``region`` (25 rows by definition of the schema) is
broadcast by hint.  The grouped outputs have one row per
(commodity, district, date), so their size grows with the number of keys and
days, not with the number of line items; the aggregation is partial
(map-side) before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.functions import safe_div
from pricelens.sources.tables import read_table, table_path

PANEL_KEYS = ("commodity", "district")


def region_of_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation key -> region name; 25 rows (fixed by the schema) -> broadcast."""
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    return F.broadcast(geo.select("n_nationkey", F.col("r_name").alias("district")))


def price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-level price observations: commodity, district, date, unit_price, quantity."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    sup = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    sup_geo = (sup.join(region_of_nation(spark, sf_dir), sup.s_nationkey == F.col("n_nationkey"))
               .select("s_suppkey", "district"))
    return (li.join(part, li.l_partkey == part.p_partkey)
              .join(sup_geo, li.l_suppkey == sup_geo.s_suppkey)
              .select(F.col("p_type").alias("commodity"),
                      "district",
                      F.to_date("l_shipdate").alias("date"),
                      safe_div("l_extendedprice", "l_quantity").alias("unit_price"),
                      F.col("l_quantity").alias("quantity")))


def price_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(commodity, district, date, modal_price, arrival), unique on the key.

    Stored once per input snapshot (see ``sources.store``).
    """
    from pricelens.sources.store import materialized
    ins = [table_path(sf_dir, t) for t in ("lineitem", "part", "supplier", "nation", "region")]
    return materialized(spark, "price_panel", ins, lambda: build_price_panel(spark, sf_dir))


def build_price_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (price_rows(spark, sf_dir)
            .groupBy("commodity", "district", "date")
            .agg(F.avg("unit_price").alias("modal_price"),
                 F.sum("quantity").alias("arrival")))


def daily_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, district, rainfall_mm, max_temp, min_temp, wind), unique on (date, district)."""
    from pricelens.sources.store import materialized
    ins = [table_path(sf_dir, t) for t in ("orders", "customer", "nation", "region")]
    return materialized(spark, "daily_signal", ins, lambda: build_daily_signal(spark, sf_dir))


def build_daily_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_totalprice", "o_orderdate"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    geo = region_of_nation(spark, sf_dir)
    j = (orders.join(cust, orders.o_custkey == cust.c_custkey)
               .join(geo, F.col("c_nationkey") == geo.n_nationkey))
    g = (j.groupBy(F.to_date("o_orderdate").alias("date"), "district")
          .agg(F.avg("o_totalprice").alias("_avg"), F.sum("o_totalprice").alias("_sum"),
               F.count(F.lit(1)).alias("_n")))
    # Fixed scaling constants of the stand-in weather.
    return g.select(
        "date", "district",
        ((g._sum % F.lit(150000.0)) / F.lit(1250.0)).alias("rainfall_mm"),
        (F.lit(20.0) + g._avg / F.lit(20000.0)).alias("max_temp"),
        (F.lit(10.0) + g._avg / F.lit(50000.0)).alias("min_temp"),
        (g._n.cast("double") * F.lit(7.5)).alias("wind"))


# Fixed-date public holidays (month, day, name) used for the
# test-data calendar, one row per holiday per year of the data.
FIXED_DATE_HOLIDAYS = [
    (1, 26, "Republic Day"),
    (5, 1, "Maharashtra Day"),
    (8, 15, "Independence Day"),
    (10, 2, "Gandhi Jayanti"),
    (12, 25, "Christmas"),
]


def holiday_calendar(spark: SparkSession, dates: DataFrame, date_col: str = "date") -> DataFrame:
    """(date, festival, holiday) for every year spanned by ``dates``.

    One tiny aggregate (min/max year) sizes the calendar: it has
    5 rows per year, independent of the data volume.
    """
    hol = F.array(*[F.struct(F.lit(m).alias("month"), F.lit(d).alias("day"),
                             F.lit(name).alias("festival"))
                    for m, d, name in FIXED_DATE_HOLIDAYS])
    years = (dates.agg(F.min(F.year(date_col)).alias("y0"), F.max(F.year(date_col)).alias("y1"))
                  .select(F.explode(F.sequence("y0", "y1")).alias("year")))
    return (years.select("year", F.inline(hol))
                 .select(F.make_date("year", "month", "day").alias("date"),
                         "festival", F.lit(1).alias("holiday")))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holiday calendar spanning the years of the price panel."""
    return holiday_calendar(spark, price_panel(spark, sf_dir).select("date"))


# Test-data cultivation cost per commodity (one literal per p_type, set near
# the monthly price median so both sides of the below-cost test occur).
COST_OF_CULTIVATION = [
    ("ECONOMY", 4500.0),
    ("LARGE", 4000.0),
    ("MEDIUM", 5000.0),
    ("PROMO", 4200.0),
    ("SMALL", 5500.0),
    ("STANDARD", 3800.0),
]


def cost_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COST_OF_CULTIVATION, "commodity string, cost double")


def price_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction requests: every commodity traded in a district, on every day
    with a weather record for that district (date, district, commodity,
    arrival, max_temp, min_temp, rainfall_mm, wind).

    Equi-join of the (commodity, district) keys with the daily signal on
    district: one request per key and weather day.
    """
    from pricelens.operators.stats import broadcast_if_small
    keys = price_panel(spark, sf_dir).select("commodity", "district").distinct()
    ds = daily_signal(spark, sf_dir)
    return (ds.join(broadcast_if_small(keys), "district")
              .select("date", "district", "commodity",
                      (F.col("wind") * F.lit(10.0)).alias("arrival"),
                      "max_temp", "min_temp", "rainfall_mm", "wind"))
