"""Sinks (S6, S11): CSV at the edges, Parquet between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """CSV with a header.  ``single_file`` is for small reports only
    (one writer task); tables stay multi-file."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> None:
    """Stage table; ``partition_by`` (e.g. commodity) enables partition pruning."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def write_predictions(pred: DataFrame, path: str, keys=("commodity", "district", "date"),
                      label: str = "modal_price") -> None:
    """Scored rows with actual, prediction and residual, partitioned by commodity."""
    from pyspark.sql import functions as F
    out = pred.select(*keys, label, "prediction", (F.col(label) - F.col("prediction")).alias("error"))
    write_parquet(out, path, partition_by="commodity")


def append_run_log(df: DataFrame, path: str) -> None:
    """Append one summary row per model run to a run-log table."""
    from pyspark.sql import functions as F
    df.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)
