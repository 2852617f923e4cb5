"""Regression and classification metrics as plain aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str = "modal_price", pred: str = "prediction",
                       keys=(), min_rows: int = 1) -> DataFrame:
    """MAE, RMSE, R2 (overall or per slice).  R2 is NULL for a single row or a
    constant label; slices with fewer than ``min_rows`` rows are dropped."""
    e = F.col(label) - F.col(pred)
    g = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"), F.sum(e * e).alias("_sse"),
        (F.count(F.lit(1)) * F.var_pop(label)).alias("_sst"))
    g = g.withColumn("r2", F.when(F.col("rows") > 1, F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst"))))
    return g.filter(F.col("rows") >= min_rows).drop("_sse", "_sst")


def confusion_matrix(df: DataFrame, label: str, pred: str, classes) -> DataFrame:
    """rows = actual class, one column per predicted class, fixed order."""
    return (df.groupBy(F.col(label).alias("actual")).pivot(pred, list(classes))
              .agg(F.count(F.lit(1))).na.fill(0))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision/recall/F1/support plus weighted averages and accuracy."""
    tp = F.sum((F.col(label) == F.col(pred)).cast("long"))
    per_pred = df.groupBy(F.col(pred).alias("cls")).agg(F.count(F.lit(1)).alias("predicted"))
    per_act = df.groupBy(F.col(label).alias("cls")).agg(F.count(F.lit(1)).alias("support"), tp.alias("tp"))
    r = per_act.join(per_pred, "cls", "full_outer").na.fill(0)
    r = r.withColumns({"precision": F.try_divide(F.col("tp"), F.col("predicted")),
                       "recall": F.try_divide(F.col("tp"), F.col("support"))})
    r = r.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"),
                                        F.col("precision") + F.col("recall")))
    return r.select("cls", "support", "precision", "recall", "f1")
