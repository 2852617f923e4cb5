"""Batch scoring of price requests (M22), re-aimed from the web form.

Requests are a DataFrame; every validation failure becomes an ``error``
text instead of an HTTP status.  Valid requests get as-of history features
(J12), calendar parts, a model prediction (clamped at 0), the commodity /
district intelligence (J13) and the 30-day forecast list of their key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions import is_weekend, weekday0
from pricelens.ml.grouped_trees import TreeModel
from pricelens.operators.asof import asof_features
from pricelens.operators.stats import broadcast_if_small


# Validation messages, checked in this order (first failure wins).
MESSAGES = {
    "arrival": "Arrival cannot be negative.",
    "rainfall": "Rainfall cannot be negative.",
    "wind": "Wind speed cannot be negative.",
    "month": "Month must be between 1 and 12.",
    "day": "Day must be between 1 and 31.",
    "date": "Invalid calendar date.",
    "unknown": "Unknown commodity or district.",
    "history": "Not enough price history (need 30 earlier prices).",
}


def request_date(year="year", month="month", day="day"):
    """Calendar date from form fields; NULL for impossible dates (31 April)."""
    txt = F.format_string("%04d-%02d-%02d", F.col(year), F.col(month), F.col(day))
    return F.try_to_date(txt, "yyyy-MM-dd")


def validate(requests: DataFrame, known: DataFrame) -> DataFrame:
    """Rule chain, first failure wins; ``known`` = (commodity, district) pairs seen in training.

    Requests carry either a ``date`` or the form fields ``year``/``month``/``day``.
    """
    r = requests
    has_parts = all(c in r.columns for c in ("year", "month", "day"))
    if has_parts and "date" not in r.columns:
        r = r.withColumn("date", request_date())
    k = known.select("commodity", "district", F.lit(True).alias("_known"))
    r = r.join(broadcast_if_small(k), ["commodity", "district"], "left")
    err = (F.when(F.col("arrival") < 0, MESSAGES["arrival"])
            .when(F.col("rainfall_mm") < 0, MESSAGES["rainfall"])
            .when(F.col("wind") < 0, MESSAGES["wind"]))
    if has_parts:
        err = (err.when((F.col("month") < 1) | (F.col("month") > 12), MESSAGES["month"])
                  .when((F.col("day") < 1) | (F.col("day") > 31), MESSAGES["day"]))
    err = (err.when(F.col("date").isNull(), MESSAGES["date"])
              .when(F.col("_known").isNull(), MESSAGES["unknown"]))
    return r.withColumn("error", err).drop("_known")


def score_requests(requests: DataFrame, history: DataFrame, model: TreeModel,
                   intel: DataFrame | None = None, forecast: DataFrame | None = None) -> DataFrame:
    known = history.select("commodity", "district").distinct()
    v = validate(requests, known)
    valid_date = v.filter(F.col("date").isNotNull())
    f = asof_features(valid_date, history).unionByName(
        v.filter(F.col("date").isNull()).withColumns(
            {c: F.lit(None).cast("double") for c in ["lag_1", "lag_2", "lag_3", "rolling_7", "rolling_30"]})
        .withColumns({"history_rows": F.lit(0), "history_ok": F.lit(False)}))
    f = f.withColumn("error", F.coalesce(F.col("error"), F.when(~F.col("history_ok"), F.lit(MESSAGES["history"]))))
    d = F.col("date")
    f = f.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d), "day_of_week": weekday0(d),
                       "quarter": F.quarter(d), "weekend_int": is_weekend(d).cast("int"),
                       "festival": F.coalesce(F.col("festival") if "festival" in f.columns else F.lit(None),
                                              F.lit("No Festival")),
                       "holiday": F.coalesce(F.col("holiday") if "holiday" in f.columns else F.lit(None), F.lit(0))})
    ok = f.filter(F.col("error").isNull())
    scored = model.transform(ok).withColumn("predicted_price", F.bround(F.greatest("prediction", F.lit(0.0)), 2))
    cols = [c for c in f.columns] + ["predicted_price"]
    out = scored.select(*cols).unionByName(f.filter(F.col("error").isNotNull())
                                            .withColumn("predicted_price", F.lit(None).cast("double")))
    if intel is not None:
        out = out.join(broadcast_if_small(intel), ["commodity", "district"], "left")
    if forecast is not None:
        fl = (forecast.groupBy("commodity", "district")
                      .agg(F.array_sort(F.collect_list(F.struct("date", "predicted_price"))).alias("forecast_30d")))
        out = out.join(fl, ["commodity", "district"], "left")
    return out
