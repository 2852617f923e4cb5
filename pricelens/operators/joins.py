"""Join operators (J1-J16) beyond the panel assembly in ``operators.panel``.

Small dimension sides (calendar, cost table, named periods, event windows)
have a size bounded by construction (days x a literal list) and are
broadcast; data-sized sides are left to Catalyst/AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pricelens.operators.stats import broadcast_if_small


def missing_dates(df: DataFrame, keys, date_col: str = "date") -> DataFrame:
    """Calendar days between each key's first and last date that have no row.

    The day grid is generated per key with ``sequence`` (size = key span in
    days, independent of row volume) and anti-joined with the observed days.
    """
    keys = list(keys)
    bounds = df.groupBy(*keys).agg(F.min(date_col).alias("_d0"), F.max(date_col).alias("_d1"))
    grid = bounds.select(*keys, F.explode(F.sequence("_d0", "_d1")).alias(date_col))
    seen = df.select(*keys, date_col)
    return grid.join(seen, keys + [date_col], "left_anti")


def expand_periods(periods: DataFrame, start="start", end="end") -> DataFrame:
    """One row per day of every [start, end] period (for an equi-join on date).

    Turns the range join ``date BETWEEN start AND end`` (a nested-loop join)
    into a hash join; the expanded side has sum(period lengths) rows.
    """
    others = [c for c in periods.columns if c not in (start, end)]
    return periods.select(*others, start, end,
                          F.explode(F.sequence(F.col(start), F.col(end))).alias("date"))


def event_windows(events: DataFrame, date_col="event_date", before: int = 30, after: int = 30) -> DataFrame:
    """One row per day in [event - before, event + after] with its offset and side."""
    return (events.select("*", F.explode(F.sequence(F.lit(-before), F.lit(after))).alias("offset"))
                  .select("*", F.date_add(F.col(date_col), F.col("offset")).alias("date"),
                          F.when(F.col("offset") < 0, F.lit("before")).otherwise(F.lit("after")).alias("side")))


def unseen_categories(train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` in ``test`` never seen in ``train``."""
    return (test.select(column).distinct()
                .join(train.select(column).distinct(), column, "left_anti"))


def code_map(df: DataFrame, labels: DataFrame, column: str, code_col: str = "code",
             unseen: int = -1) -> DataFrame:
    """Category -> integer code by a dimension join; unseen -> ``unseen``."""
    return (df.join(broadcast_if_small(labels), column, "left")
              .withColumn(code_col, F.coalesce(F.col(code_col), F.lit(unseen))))
