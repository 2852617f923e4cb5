"""Market-extract pipeline: the raw files of a price-panel user -> the panel.

Raw price CSVs (positional, all-string, banner/header/footer rows) are
cleaned; weather payloads become (date, district) rows; the state-level
prices meet the district weather on the date (the date-only join creates the
district axis, as the original feature stage does), the event calendar is
joined per date and weather gaps are filled within each series.  Column names
of existing final-dataset files are normalised with ``normalize_columns``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.operators.clean import clean_raw_prices, drop_header_rows
from pricelens.operators.panel import add_calendar_parts, join_calendar, join_weather
from pricelens.operators.windows import fill_within_keys
from pricelens.sources.raw import RAW_PRICE_SCHEMA, read_csv, read_weather_payloads

# Final-dataset column names -> library column names.
COLUMN_MAP = {
    "State": "state", "Commodity_Group": "commodity_group", "Commodity": "commodity", "District": "district",
    "Date": "date", "Arrival": "arrival", "Modal_Price": "modal_price", "Max_Temp": "max_temp",
    "Min_Temp": "min_temp", "Rainfall_mm": "rainfall_mm", "Rain_mm": "rain_mm", "WindSpeed": "wind",
    "Festival": "festival", "Holiday": "holiday", "Month": "month", "Year": "year", "Day": "day",
    "Weekend": "weekend", "DayOfWeek": "day_of_week", "Quarter": "quarter", "Lag_1": "lag_1", "Lag_2": "lag_2",
    "Lag_3": "lag_3", "Rolling_7": "rolling_7", "Rolling_30": "rolling_30", "Price_Change": "price_change",
}


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename final-dataset columns to the library's names (others kept)."""
    return df.withColumnsRenamed({k: v for k, v in COLUMN_MAP.items() if k in df.columns})


def market_panel(spark: SparkSession, price_paths, weather_paths, calendar: DataFrame | None = None,
                 banner: str | None = None) -> DataFrame:
    """Panel (commodity, district, date, modal_price, arrival, weather, calendar parts).

    A price on a day without weather stays, with a null district and weather.
    """
    raw = read_csv(spark, price_paths, RAW_PRICE_SCHEMA, header=False)
    if banner:
        raw = drop_header_rows(raw, {"State": banner})
    prices = clean_raw_prices(raw)
    weather = read_weather_payloads(spark, weather_paths).drop("rain_mm")
    panel = join_weather(prices.select("commodity", "date", "modal_price", "arrival"), weather, on=("date",))
    if calendar is not None:
        panel = join_calendar(panel, calendar.select("date", "festival", "holiday"))
    panel = fill_within_keys(panel, ["max_temp", "min_temp", "rainfall_mm", "wind"])
    return add_calendar_parts(panel)
