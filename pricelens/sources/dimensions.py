"""Literal dimension tables of the market data.

Fixed values: the event calendar 2023-2025, the cultivation cost per crop,
the festival (Navratri) periods and the policy-announcement date used by the
analyses.  They apply to the market extracts; the test-data adapter derives
its own calendar and cost table instead.  The calendar keeps the double
entry for 2025-10-02 (two festivals on one day); ``panel.calendar_one_per_date``
collapses it before joining.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.functions import is_weekend

# Fixed values: (date, festival, holiday) in calendar order.
EVENTS_2023_2025 = [
    ("2023-01-26", "Republic Day", 1),
    ("2023-03-08", "Holi", 1),
    ("2023-03-22", "Gudi Padwa", 1),
    ("2023-04-04", "Mahavir Jayanti", 1),
    ("2023-04-07", "Good Friday", 1),
    ("2023-04-14", "Dr. Ambedkar Jayanti", 1),
    ("2023-04-22", "Eid-ul-Fitr", 1),
    ("2023-05-01", "Maharashtra Day", 1),
    ("2023-06-29", "Bakrid", 1),
    ("2023-08-15", "Independence Day", 1),
    ("2023-09-19", "Ganesh Chaturthi", 1),
    ("2023-10-02", "Gandhi Jayanti", 1),
    ("2023-10-24", "Dussehra", 1),
    ("2023-11-12", "Diwali", 1),
    ("2023-11-27", "Guru Nanak Jayanti", 1),
    ("2023-12-25", "Christmas", 1),
    ("2024-01-26", "Republic Day", 1),
    ("2024-03-25", "Holi", 1),
    ("2024-04-09", "Gudi Padwa", 1),
    ("2024-04-11", "Eid-ul-Fitr", 1),
    ("2024-04-14", "Dr. Ambedkar Jayanti", 1),
    ("2024-05-01", "Maharashtra Day", 1),
    ("2024-06-17", "Bakrid", 1),
    ("2024-08-15", "Independence Day", 1),
    ("2024-09-07", "Ganesh Chaturthi", 1),
    ("2024-10-02", "Gandhi Jayanti", 1),
    ("2024-10-12", "Dussehra", 1),
    ("2024-11-01", "Diwali", 1),
    ("2024-12-25", "Christmas", 1),
    ("2025-01-26", "Republic Day", 1),
    ("2025-03-14", "Holi", 1),
    ("2025-03-30", "Gudi Padwa", 1),
    ("2025-03-31", "Eid-ul-Fitr", 1),
    ("2025-04-14", "Dr. Ambedkar Jayanti", 1),
    ("2025-05-01", "Maharashtra Day", 1),
    ("2025-06-07", "Bakrid", 1),
    ("2025-08-15", "Independence Day", 1),
    ("2025-08-27", "Ganesh Chaturthi", 1),
    ("2025-10-02", "Gandhi Jayanti", 1),
    ("2025-10-02", "Dussehra", 1),
    ("2025-10-20", "Diwali", 1),
    ("2025-12-25", "Christmas", 1),
]

# Cultivation cost per quintal.
CULTIVATION_COST = [("Onion", 1400.0), ("Potato", 1300.0), ("Rice", 2500.0), ("Tomato", 1600.0), ("Wheat", 2000.0)]

# Navratri periods (inclusive) and the policy-announcement date.
NAVRATRI_PERIODS = [("2023-10-15", "2023-10-23"), ("2024-10-03", "2024-10-11"), ("2025-09-22", "2025-09-30")]
POLICY_EVENT_DATE = "2023-12-08"


def event_calendar(spark: SparkSession) -> DataFrame:
    """(date, festival, holiday, month, year, day, weekend)."""
    df = spark.createDataFrame(EVENTS_2023_2025, "d string, festival string, holiday int")
    d = F.to_date("d")
    return df.select(d.alias("date"), "festival", "holiday", F.month(d).alias("month"), F.year(d).alias("year"),
                     F.dayofmonth(d).alias("day"), is_weekend(d).alias("weekend"))


def cultivation_cost(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CULTIVATION_COST, "commodity string, cost double")


def navratri_periods(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(NAVRATRI_PERIODS, "s string, e string")
    return df.select(F.lit("Navratri").alias("name"), F.to_date("s").alias("start"), F.to_date("e").alias("end"))


def policy_events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("policy_announcement", dt.date.fromisoformat(POLICY_EVENT_DATE))],
                                 "event string, event_date date")
