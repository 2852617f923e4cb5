"""Readers for the driver tables (one parquet file/directory per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from pricelens.operators.clean import require_columns

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Parquet scan; selecting ``columns`` here lets the scan prune the rest."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return require_columns(df, columns).select(*columns) if columns else df
