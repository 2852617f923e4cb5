"""Per-key time-series features as window expressions.

All windows are ``partitionBy(keys).orderBy(order)`` with a *row* frame, which
is what pandas ``shift``/``rolling(n)`` mean.  Several features over the same
spec are added in one ``select`` so Catalyst plans a single Sort + Window.

Scale: the window shuffles the panel by its keys; a panel has one row per
(key, day), so a key holds at most a few thousand rows.  For histories long
enough to make a single key a straggler, ``blocked_features`` splits each key
into time blocks with a look-back overlap and gives identical results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions import col, pct_change, safe_div


def spec(keys, order):
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*[col(o) for o in order])


def lag(x, k: int, w) -> Column:
    return F.lag(col(x), k).over(w)


def lead(x, k: int, w) -> Column:
    return F.lead(col(x), k).over(w)


def rolling(agg: str, x, n: int, w, include_current: bool = True, min_periods: int | None = None) -> Column:
    """pandas ``rolling(n, min_periods).agg()`` on rows; optionally shifted by one row.

    include_current=True : rows (-(n-1) .. 0)   == x.rolling(n).agg()
    include_current=False: rows (-n .. -1)      == x.shift(1).rolling(n).agg()
    The result is NULL until ``min_periods`` (default n) non-NULL values are in the frame.
    """
    m = n if min_periods is None else min_periods
    frame = w.rowsBetween(-(n - 1), 0) if include_current else w.rowsBetween(-n, -1)
    c = col(x)
    fn = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum, "min": F.min, "max": F.max}[agg]
    return F.when(F.count(c).over(frame) >= F.lit(m), fn(c).over(frame))


def add_history_features(df: DataFrame, keys=("commodity", "district"), order="date",
                         value="modal_price", lags=(1, 2, 3), windows=(7, 30),
                         include_current: bool = False, min_periods: int | None = None,
                         prefix: str = "") -> DataFrame:
    """Lag_k and Rolling_n columns (W1, W4, W5, W6) in one window pass."""
    w = spec(keys, order)
    cols = [lag(value, k, w).alias(f"{prefix}lag_{k}") for k in lags]
    cols += [rolling("mean", value, n, w, include_current,
                     (n if min_periods is None else min_periods)).alias(f"{prefix}rolling_{n}")
             for n in windows]
    return df.select("*", *cols)


def add_change_features(df: DataFrame, keys=("commodity", "district"), order="date",
                        value="modal_price") -> DataFrame:
    """First difference (W8) and percent change."""
    w = spec(keys, order)
    prev = lag(value, 1, w)
    return df.select("*", (col(value) - prev).alias("price_change"),
                     pct_change(value, prev).alias("price_change_pct"))


def add_rolling_zscore(df: DataFrame, value: str, keys=("commodity", "district"), order="date",
                       n: int = 30, min_periods: int = 5, name: str | None = None,
                       zero_std_as_zero: bool = False) -> DataFrame:
    """Rolling mean/std (W7), deviation and z-score.

    A zero rolling std gives a NULL z-score (pandas ``replace(0, nan)``);
    ``zero_std_as_zero`` turns NULL into 0 as the outlier labeller does.
    """
    name = name or value
    w = spec(keys, order)
    mean = rolling("mean", value, n, w, True, min_periods)
    std = rolling("std", value, n, w, True, min_periods)
    out = df.select("*", mean.alias(f"{name}_rolling_mean"), std.alias(f"{name}_rolling_std"))
    dev = col(value) - F.col(f"{name}_rolling_mean")
    z = safe_div(dev, F.col(f"{name}_rolling_std"))
    if zero_std_as_zero:
        z = F.coalesce(z, F.lit(0.0))
    return out.select("*", dev.alias(f"{name}_deviation"), z.alias(f"{name}_zscore"))


def fill_within_keys(df: DataFrame, columns, keys=("commodity", "district"), order="date") -> DataFrame:
    """Back-fill then forward-fill inside each key (P13), never across keys.

    Both fills are running frames (O(n) per key): the back-fill is the last
    non-NULL value of a frame that runs from the end of the series, i.e. a
    descending-order running window, instead of an unbounded-following frame.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    if not order:
        raise ValueError("fill needs an order")
    behind = Window.partitionBy(*keys).orderBy(*[F.col(o).asc() for o in order]) \
        .rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order]) \
        .rowsBetween(Window.unboundedPreceding, 0)
    repl = {c: F.coalesce(F.last(c, ignorenulls=True).over(ahead), F.last(c, ignorenulls=True).over(behind))
            for c in columns}
    return df.withColumns(repl)


def first_last_n_mean(df: DataFrame, value: str, keys, order, n: int = 3) -> DataFrame:
    """Mean of the first n and the last n rows per group."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    asc = Window.partitionBy(*keys).orderBy(F.col(order).asc())
    desc = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    r = df.select(*keys, value, F.row_number().over(asc).alias("_ra"),
                  F.row_number().over(desc).alias("_rd"))
    r = r.filter((F.col("_ra") <= n) | (F.col("_rd") <= n))
    return r.groupBy(*keys).agg(
        F.avg(F.when(F.col("_ra") <= n, F.col(value))).alias("first_mean"),
        F.avg(F.when(F.col("_rd") <= n, F.col(value))).alias("last_mean"))


def top1_per_group(df: DataFrame, keys, order_cols) -> DataFrame:
    """Keep the first row per group under a total order."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def row_rank_split(df: DataFrame, keys, order, frac: float = 0.8) -> DataFrame:
    """is_train = first floor(frac * n) rows of every key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = spec(keys, order)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("is_train", F.row_number().over(w) <= F.floor(n * F.lit(frac)))


def compare_features(df: DataFrame, pairs: dict, rtol: float = 1e-5, atol: float = 1e-8,
                     tol: float = 0.01) -> DataFrame:
    """Stored-vs-recomputed check, one row per feature.

    ``pairs`` maps feature name -> (stored column, recomputed column).
    """
    from pricelens.functions import isclose
    stack = F.inline(F.array(*[
        F.struct(F.lit(name).alias("feature"), col(a).cast("double").alias("stored"),
                 col(b).cast("double").alias("recomputed"))
        for name, (a, b) in pairs.items()]))
    long = df.select(stack)
    diff = F.abs(F.col("stored") - F.col("recomputed"))
    return long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(isclose("stored", "recomputed", rtol, atol)).alias("n_close"),
        F.count_if(diff < F.lit(tol)).alias("n_within_tol"),
        F.avg(diff).alias("mean_abs_diff"),
        F.max(diff).alias("max_abs_diff"))


def blocked_history_features(df: DataFrame, keys=("commodity", "district"), order="date",
                             value="modal_price", lags=(1, 2, 3), windows=(7, 30),
                             include_current: bool = False, min_periods: int | None = None,
                             block_days: int = 365, prefix: str = "") -> DataFrame:
    """``add_history_features`` for very long series: same result, more tasks.

    A plain window puts a whole key in one task, so a key with a long history
    (or a hot key) becomes a straggler.  Here each key is cut into time blocks
    of ``block_days``; every row is also copied into the following blocks
    for which it lies within the look-back L = max(lags, windows) rows of the
    block start.  The window then runs per (key, block) and only the block's
    own rows are kept.  Copies per block <= L rows, independent of data size.

    Block bookkeeping uses only a small (key, block) count table; the list of
    later blocks per key is collected per key (one entry per block).
    """
    keys = list(keys)
    look = max(list(lags) + list(windows) + [1])
    blk = F.floor(F.unix_date(F.col(order)) / F.lit(block_days)).cast("long")
    d = df.withColumn("_blk", blk)
    counts = d.groupBy(*keys, "_blk").agg(F.count(F.lit(1)).alias("_cnt"))
    cw = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_cnt").over(cw), F.lit(0)))
    plan = counts.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_blk").alias("b"), F.col("_before").alias("c")))).alias("_blocks"))
    own = Window.partitionBy(*keys, "_blk").orderBy(F.col(order).desc())
    d = (d.join(counts, keys + ["_blk"]).join(plan, keys)
          .withColumn("_e", F.row_number().over(own)))
    # rows from this row to the start of block b (exclusive of b) must be <= look
    targets = F.filter("_blocks", lambda x: (x["b"] > F.col("_blk")) &
                       ((x["c"] - (F.col("_before") + F.col("_cnt")) + F.col("_e")) <= F.lit(look)))
    base_cols = df.columns
    home = d.select(*base_cols, F.col("_blk").alias("_part"), F.lit(False).alias("_copy"))
    copies = d.select(*base_cols, F.explode(F.transform(targets, lambda x: x["b"])).alias("_part"),
                      F.lit(True).alias("_copy"))
    u = home.unionByName(copies)
    out = add_history_features(u, keys + ["_part"], order, value, lags, windows, include_current,
                               min_periods, prefix)
    return out.filter(~F.col("_copy")).drop("_part", "_copy")
