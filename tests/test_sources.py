import json
import os
import tempfile

from pricelens.operators import clean as C
from pricelens.sources import raw as RW


def test_csv_banner_header_footer_and_lineage(spark):
    d = tempfile.mkdtemp(prefix="pricelens-csv-")
    lines = ["Daily prices report,,,,,,,",
             "State/UT,Commodity Group,Commodity,Date,Arrival,Unit,Modal Price,Unit",
             'Maharashtra,Vegetables,Onion,01-01-2024,"1,234.50",Tonnes,"2,150.00",Rs./Quintal',
             'Maharashtra,Vegetables,Onion,01-01-2024,"1,234.50",Tonnes,"2,150.00",Rs./Quintal',
             'Maharashtra,Vegetables,Onion,31-02-2024,"10.00",Tonnes,"2,000.00",Rs./Quintal',
             'Maharashtra,Vegetables,Onion,02-01-2024,"abc",Tonnes,"2,000.00",Rs./Quintal',
             "Note: provisional,,,,,,,", "Weighted average,,,,,,,"]
    for i in range(2):
        with open(os.path.join(d, f"q{i}.csv"), "w") as f:
            f.write("\n".join(lines) + "\n")
    raw = RW.read_csv(spark, os.path.join(d, "*.csv"), RW.RAW_PRICE_SCHEMA, header=False, lineage=True)
    assert raw.select("source_file").distinct().count() == 2
    clean = C.clean_raw_prices(C.drop_header_rows(raw.drop("source_file"), {"State": "Daily prices report"}))
    rows = clean.collect()
    assert len(rows) == 1
    assert rows[0].arrival == 1234.5 and rows[0].modal_price == 2150.0 and str(rows[0].date) == "2024-01-01"


def test_weather_json_payload(spark):
    d = tempfile.mkdtemp(prefix="pricelens-json-")
    doc = {"district": "Pune", "daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [30.0, 31.5],
                                         "temperature_2m_min": [15.0, 16.0], "precipitation_sum": [0.0, 2.5],
                                         "rain_sum": [0.0, 2.0], "windspeed_10m_max": [10.0, 12.0]}}
    with open(os.path.join(d, "pune.json"), "w") as f:
        json.dump(doc, f, indent=2)
    rows = RW.read_weather_payloads(spark, d).orderBy("date").collect()
    assert len(rows) == 2 and rows[1].max_temp == 31.5 and rows[1].rain_mm == 2.0 and rows[0].district == "Pune"


def test_html_table_rows(spark):
    html = ("<html><table><tr><th>State</th></tr><tr><td>MH</td><td><b>G</b></td><td>Onion</td><td>01-01-2024</td>"
            "<td>1,000.00</td><td>T</td><td>2,000.00</td><td>Rs</td></tr></table></html>")
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = RW.html_table_rows(df).collect()
    assert len(rows) == 1 and rows[0].Commodity_Group == "G" and rows[0].Modal_Price == "2,000.00"


def test_csv_sink_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="pricelens-sink-")
    df = spark.createDataFrame([("Onion", 1.5), ("Rice", 2.0)], "commodity string, price double")
    df.write.mode("overwrite").option("header", True).csv(d + "/out")
    back = RW.read_csv(spark, d + "/out", df.schema).orderBy("commodity").collect()
    assert [(r.commodity, r.price) for r in back] == [("Onion", 1.5), ("Rice", 2.0)]


def test_literal_dimensions(spark):
    from pricelens.operators.panel import calendar_one_per_date
    from pricelens.sources import dimensions as DM
    cal = DM.event_calendar(spark)
    assert cal.count() == 42
    assert cal.filter("date = DATE'2025-10-02'").count() == 2
    one = calendar_one_per_date(cal).filter("date = DATE'2025-10-02'").first()
    assert one.festival == "Dussehra / Gandhi Jayanti"
    assert DM.cultivation_cost(spark).count() == 5
    p = DM.navratri_periods(spark).collect()
    assert len(p) == 3 and (p[0].end - p[0].start).days == 8


def test_market_pipeline_from_raw_files(spark):
    from pricelens.sources import dimensions as DM
    from pricelens.sources.market import market_panel, normalize_columns
    d = tempfile.mkdtemp(prefix="pricelens-market-")
    os.makedirs(f"{d}/prices"); os.makedirs(f"{d}/weather")
    with open(f"{d}/prices/q1.csv", "w") as f:
        f.write("\n".join([
            "Daily report,,,,,,,",
            "State/UT,Commodity Group,Commodity,Date,Arrival,Unit,Modal Price,Unit",
            'Maharashtra,Vegetables,Onion,01-10-2025,"1,000.00",Tonnes,"2,000.00",Rs./Quintal',
            'Maharashtra,Vegetables,Onion,02-10-2025,"1,100.00",Tonnes,"2,100.00",Rs./Quintal',
            "Note: provisional,,,,,,,"]) + "\n")
    for dist, temps in [("Pune", [30.0, None]), ("Nashik", [28.0, 29.0])]:
        doc = {"district": dist, "daily": {"time": ["2025-10-01", "2025-10-02"], "temperature_2m_max": temps,
                                           "temperature_2m_min": [15.0, 16.0], "precipitation_sum": [0.0, 1.0],
                                           "rain_sum": [0.0, 1.0], "windspeed_10m_max": [5.0, 6.0]}}
        with open(f"{d}/weather/{dist}.json", "w") as f:
            json.dump(doc, f)
    p = market_panel(spark, f"{d}/prices/*.csv", f"{d}/weather", DM.event_calendar(spark), banner="Daily report")
    rows = {(r.district, str(r.date)): r for r in p.collect()}
    assert len(rows) == 4  # 2 days x 2 districts (date-only join)
    assert rows[("Pune", "2025-10-02")].max_temp == 30.0  # filled within the Pune series
    assert rows[("Nashik", "2025-10-02")].festival == "Dussehra / Gandhi Jayanti"
    assert rows[("Nashik", "2025-10-01")].festival == "No Festival" and rows[("Nashik", "2025-10-01")].holiday == 0
    n = normalize_columns(spark.createDataFrame([("Onion", 1.0)], "Commodity string, Modal_Price double"))
    assert n.columns == ["commodity", "modal_price"]
