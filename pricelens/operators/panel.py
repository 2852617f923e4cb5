"""Panel assembly: weather and calendar joins, calendar parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions import is_weekend, weekday0
from pricelens.sources.adapter import calendar, daily_signal, price_panel

NO_FESTIVAL = "No Festival"  # fill value of the calendar join (fixed value)


def join_weather(panel: DataFrame, weather: DataFrame, on=("date", "district")) -> DataFrame:
    """Left join of the district weather.

    ``on=("date",)`` is the reference's date-only join, which fans every
    price row out to all districts of that day.  Weather has one row per
    (date, district), so the join is an equi-join Catalyst can broadcast when
    its measured size is below the broadcast threshold and sort-merge beyond.
    """
    return panel.join(weather, list(on), "left")


def panel_with_weather(spark, sf_dir) -> DataFrame:
    return join_weather(price_panel(spark, sf_dir), daily_signal(spark, sf_dir))


def calendar_one_per_date(cal: DataFrame) -> DataFrame:
    """Collapse duplicate calendar dates: festival names joined by ' / '."""
    return (cal.groupBy("date")
               .agg(F.array_join(F.array_sort(F.collect_set("festival")), " / ").alias("festival"),
                    F.max("holiday").alias("holiday")))


def join_calendar(panel: DataFrame, cal: DataFrame, dedupe: bool = True) -> DataFrame:
    """Left join of the event calendar + default fill.

    The calendar has a handful of rows per year; with ``dedupe`` it is first
    reduced to one row per date so the join never multiplies price rows.
    """
    c = calendar_one_per_date(cal) if dedupe else cal
    # bound: one row per calendar date (a few per year)
    return (panel.join(F.broadcast(c), "date", "left")
                 .withColumn("festival", F.coalesce("festival", F.lit(NO_FESTIVAL)))
                 .withColumn("holiday", F.coalesce("holiday", F.lit(0))))


def add_calendar_parts(df: DataFrame, date_col: str = "date") -> DataFrame:
    d = F.col(date_col)
    return df.withColumns({
        "year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d),
        "day_of_week": weekday0(d), "quarter": F.quarter(d), "weekend": is_weekend(d)})


def feature_panel(spark, sf_dir) -> DataFrame:
    """Panel + weather + calendar + calendar parts (the reference's final dataset)."""
    p = panel_with_weather(spark, sf_dir)
    p = join_calendar(p, calendar(spark, sf_dir))
    return add_calendar_parts(p)
