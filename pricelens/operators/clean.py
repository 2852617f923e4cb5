"""Cleaning operators (P1-P23): header/footer removal, coercing parses,
de-duplication, validity filters, fills and missing-value profiles.

Everything is a column expression or a one-pass aggregate; nothing is
collected to the driver except the schema check of ``require_columns``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions import col


class SchemaError(ValueError):
    pass


def require_columns(df: DataFrame, required) -> DataFrame:
    """Raise if a required column is missing (driver-side schema check only)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaError(f"missing required columns: {missing}")
    return df


def parse_number(c, strict: bool = False) -> Column:
    """P3: '1,234.50' -> 1234.5; coercing form gives NULL on junk."""
    s = F.regexp_replace(col(c).cast("string"), ",", "")
    x = s.cast("double") if strict else s.try_cast("double")
    return F.when(~F.isnan(x), x)  # a 'NaN' text is missing, never a NaN value (X5)


def parse_date(c, fmt: str = "dd-MM-yyyy", strict: bool = False) -> Column:
    """Text date; coercing form gives NULL on junk or impossible dates."""
    return F.to_date(col(c), fmt) if strict else F.try_to_date(col(c), fmt)


def drop_header_rows(df: DataFrame, checks: dict) -> DataFrame:
    """Drop repeated header lines, e.g. ``{'State': 'State/UT', 'Date': 'Date'}``.

    NULL-safe: a NULL cell is not a header marker (kept, as pandas does).
    """
    cond = reduce(lambda a, b: a & b, [~F.col(c).eqNullSafe(F.lit(v)) for c, v in checks.items()])
    return df.filter(cond)


def drop_footer_rows(df: DataFrame, column: str, prefixes) -> DataFrame:
    """Drop rows whose ``column`` starts with one of ``prefixes``."""
    c = F.coalesce(F.col(column), F.lit(""))
    bad = reduce(lambda a, b: a | b, [c.startswith(p) for p in prefixes])
    return df.filter(~bad)


def drop_nulls(df: DataFrame, subset=None) -> DataFrame:
    """P7."""
    return df.na.drop(how="any", subset=subset)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Full-row de-duplication (hash aggregate on all columns)."""
    return df.dropDuplicates()


def duplicate_row_count(df: DataFrame) -> Column:
    """P8 as an aggregate expression: rows minus distinct rows."""
    return F.count(F.lit(1)) - F.count_distinct(F.struct(*df.columns))


def dedupe_keep_first(df: DataFrame, keys, order_cols) -> DataFrame:
    """One row per key, the first under an explicit total order."""
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def duplicate_key_audit(df: DataFrame, keys, order_cols) -> DataFrame:
    """P9 audit: every member of a duplicated key with its rank and a keep flag."""
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return (df.select("*", n.alias("copies"), F.row_number().over(w).alias("rank_in_key"))
              .filter("copies > 1")
              .withColumn("kept", F.col("rank_in_key") == 1))


def duplicate_key_report(df: DataFrame, keys) -> DataFrame:
    """P10: keys with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def price_order_valid(p_min="p_min", p_modal="p_modal", p_max="p_max") -> Column:
    """Min <= modal <= max; NULL anywhere fails."""
    ok = (col(p_min) <= col(p_modal)) & (col(p_modal) <= col(p_max))
    return F.coalesce(ok, F.lit(False))


def missing_profile(df: DataFrame, columns=None) -> DataFrame:
    """(column_name, missing, rows) for every column, in one pass."""
    columns = list(columns or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.sum(F.col(c).isNull().cast("long")).alias(f"_m{i}") for i, c in enumerate(columns)])
    stack = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                        F.col(f"_m{i}").alias("missing")) for i, c in enumerate(columns)]))
    return agg.select(stack, F.col("_rows").alias("rows"))


def clean_raw_prices(raw: DataFrame) -> DataFrame:
    """The raw market extract -> typed, de-duplicated rows."""
    df = drop_header_rows(raw, {"State": "State/UT", "Date": "Date"})
    df = drop_footer_rows(df, "State", ("Note", "Weighted"))
    df = df.select(F.col("State").alias("state"), F.col("Commodity_Group").alias("commodity_group"),
                   F.col("Commodity").alias("commodity"), parse_date("Date").alias("date"),
                   parse_number("Arrival").alias("arrival"), F.col("Arrival_Unit").alias("arrival_unit"),
                   parse_number("Modal_Price").alias("modal_price"), F.col("Price_Unit").alias("price_unit"))
    return dedupe_rows(drop_nulls(df))


def clip_nonneg(c) -> Column:
    """P20: clamp at 0, NULL stays NULL."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))
