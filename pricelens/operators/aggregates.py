"""Grouped aggregates (A1-A26) that are more than a single ``agg`` call."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PIVOT_VALUES = 1000


def distinct_values(df: DataFrame, column: str, limit: int = MAX_PIVOT_VALUES) -> list:
    """Sorted distinct values of a dimension column (pivot headers).

    Only dimension columns go through here; the size is checked so a
    data-sized column can never be pulled to the driver.
    """
    vals = [r[0] for r in df.select(column).distinct().orderBy(column).limit(limit + 1).collect()]
    if len(vals) > limit:
        raise ValueError(f"{column} has more than {limit} distinct values; not a pivot dimension")
    return vals


def pivot_mean(df: DataFrame, keys, pivot_col: str, value: str, values=None) -> DataFrame:
    """Mean of ``value`` per key with one column per pivot value (fixed order)."""
    values = values if values is not None else distinct_values(df, pivot_col)
    return df.groupBy(*keys).pivot(pivot_col, values).agg(F.avg(value))


#: Series of a block of the correlation matrix.
SERIES_BLOCK = 64


def _block_corr(a, b):
    """Correlation of every column of ``a`` with every column of ``b`` over shared rows; NaN if a side is constant there."""
    import numpy as np
    ma, mb = ~np.isnan(a), ~np.isnan(b)
    # centred, so that the sums do not cancel
    x = np.where(ma, a - np.nanmean(np.where(ma.any(0), a, 0.0), axis=0), 0.0)
    y = np.where(mb, b - np.nanmean(np.where(mb.any(0), b, 0.0), axis=0), 0.0)
    ma, mb = ma.astype(float), mb.astype(float)
    n = ma.T @ mb
    with np.errstate(divide="ignore", invalid="ignore"):
        sx, sy = x.T @ mb, ma.T @ y
        vx, vy = (x * x).T @ mb - sx * sx / n, ma.T @ (y * y) - sy * sy / n
        # rounding leaves a constant side a tiny variance
        flat = (n < 2) | (vx <= 1e-12 * ((x * x).T @ mb + 1e-300)) | (vy <= 1e-12 * (ma.T @ (y * y) + 1e-300))
        return np.where(flat, np.nan, (x.T @ y - sx * sy / n) / np.sqrt(vx * vy))


def pair_correlations(df: DataFrame, keys, index: str, series: str, value: str, block: int = SERIES_BLOCK) -> DataFrame:
    """Correlation of every pair of series across a shared index.

    The correlation matrix of a group is computed block by block: a task holds
    two blocks of series and multiplies them.  Rows are copied once per block,
    never paired, and any number of series spreads over more tasks.
    """
    import numpy as np
    import pandas as pd
    from pricelens.session import ship_package
    ship_package(df.sparkSession)
    keys = list(keys)
    means = df.groupBy(*keys, index, series).agg(F.avg(value).alias("_v")).filter(F.col(series).isNotNull())
    blocks = max(1, -(-df.select(series).distinct().count() // block))
    means = means.withColumn("_own", F.pmod(F.xxhash64(series), F.lit(blocks)).cast("int"))
    rows = means.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = rows.withColumns({"_lo": F.least("_own", "_other"), "_hi": F.greatest("_own", "_other")})

    def corr(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(pdf["_lo"].iloc[0]), int(pdf["_hi"].iloc[0])
        wide = pdf.pivot(index=index, columns=["_own", series], values="_v")
        names = {k: [c[1] for c in wide.columns if c[0] == k] for k in {lo, hi}}
        if not names[lo] or not names[hi]:
            return pd.DataFrame([], columns=[*keys, "series_a", "series_b", "corr"])
        a, b = (wide[k].to_numpy(dtype="float64") for k in (lo, hi))
        r = _block_corr(a, b)
        i, j = np.nonzero(np.triu(np.ones(r.shape, bool), 1) if lo == hi else np.ones(r.shape, bool))
        x, y, v = np.array(names[lo], object)[i], np.array(names[hi], object)[j], r[i, j]
        out = pd.DataFrame({"series_a": np.concatenate([x, y]), "series_b": np.concatenate([y, x]), "corr": np.concatenate([v, v])})
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[[*keys, "series_a", "series_b", "corr"]]

    types = {f.name: f.dataType.simpleString() for f in means.schema}
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), f"series_a {types[series]}", f"series_b {types[series]}", "corr double"])
    out = rows.groupBy(*keys, "_lo", "_hi").applyInPandas(corr, schema)
    return out.withColumn("corr", F.when(~F.isnan("corr"), F.col("corr")))


def leadership_scores(df: DataFrame, keys=("commodity",), index="date", series="district",
                      value="modal_price") -> DataFrame:
    """Mean correlation of each district with every other district.

    Pairs are excluded by identity (a <> b), never by value (X16).
    """
    pc = pair_correlations(df, keys, index, series, value)
    return (pc.groupBy(*keys, F.col("series_a").alias(series))
              .agg(F.avg("corr").alias("leadership_score")))


def completeness(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct (a, b) pairs vs |distinct a| x |distinct b|."""
    from pricelens.operators.stats import distinct_count
    out = df.agg(distinct_count(a).alias(f"n_{a}"), distinct_count(b).alias(f"n_{b}"),
                 distinct_count(a, b).alias("n_pairs"))
    return out.withColumn("complete", F.col("n_pairs") == F.col(f"n_{a}") * F.col(f"n_{b}"))


def value_counts(df: DataFrame, columns, dropna: bool = True) -> DataFrame:
    """A2: counts per value combination; ``dropna=False`` keeps the NULL bucket
    (pandas ``value_counts(dropna=False)``)."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    g = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))
    if dropna:
        for c in columns:
            g = g.filter(F.col(c).isNotNull())
    return g
