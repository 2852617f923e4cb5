"""As-of history lookup (J12): price-history features for a batch of requests.

For every request (key, date) the features come from the last history rows
of the same key *strictly before* the request date: last three prices, mean
of the last 7 and 30 prices, and the number of rows available (a request
needs at least ``min_history``).

Plan: history features are computed once per history row with a row-frame
window ("as of just after this row"); requests are unioned in and pick up the
latest preceding history row with ``last(..., ignorenulls)`` over the same
key ordering, request rows sorted before same-day history rows.  This is one
shuffle by key and one sort, linear in rows: no pairs of request x history
rows are formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FEATURES = ["lag_1", "lag_2", "lag_3", "rolling_7", "rolling_30", "history_rows"]


def history_state(history: DataFrame, keys, date_col="date", value="modal_price") -> DataFrame:
    """Per history row: the features a request made on the next day would see."""
    w = Window.partitionBy(*keys).orderBy(date_col)
    r7, r30 = w.rowsBetween(-6, 0), w.rowsBetween(-29, 0)
    return history.select(
        *keys, date_col,
        F.struct(F.col(value).alias("lag_1"), F.lag(value, 1).over(w).alias("lag_2"),
                 F.lag(value, 2).over(w).alias("lag_3"),
                 F.when(F.count(value).over(r7) >= 7, F.avg(value).over(r7)).alias("rolling_7"),
                 F.when(F.count(value).over(r30) >= 30, F.avg(value).over(r30)).alias("rolling_30"),
                 F.row_number().over(w).alias("history_rows")).alias("_state"))


def asof_features(requests: DataFrame, history: DataFrame, keys=("commodity", "district"),
                  date_col="date", value="modal_price", min_history: int = 30,
                  block_days: int | None = None) -> DataFrame:
    """Features for every request; see the module docstring.

    ``block_days`` spreads a key over (key, time block) partitions so a key
    with very many requests is not one task: each block starts from the last
    history state of the earlier blocks (a small (key, block) table with a
    running ``last`` over blocks), then looks up within the block.
    """
    keys = list(keys)
    st = history_state(history, keys, date_col, value)
    part = list(keys)
    carry = None
    if block_days:
        blk = F.floor(F.unix_date(F.col(date_col)) / F.lit(block_days)).cast("long")
        st = st.withColumn("_blk", blk)
        requests_b = requests.withColumn("_blk", blk)
        last = st.groupBy(*keys, "_blk").agg(F.max_by("_state", F.col(date_col)).alias("_last"))
        blocks = (requests_b.select(*keys, "_blk").union(st.select(*keys, "_blk")).distinct()
                  .join(last, keys + ["_blk"], "left"))
        wb = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
        carry = blocks.select(*keys, "_blk", F.last("_last", ignorenulls=True).over(wb).alias("_carry"))
        part = keys + ["_blk"]
        rq = requests_b
    else:
        rq = requests
    rq = rq.select("*", F.lit(True).alias("_is_req"),
                   F.lit(None).cast(st.schema["_state"].dataType).alias("_state"))
    hs = st.withColumn("_is_req", F.lit(False))
    u = rq.unionByName(hs, allowMissingColumns=True)
    # request rows first among equal dates -> only strictly earlier history precedes them
    w = (Window.partitionBy(*part).orderBy(F.col(date_col), (~F.col("_is_req")))
         .rowsBetween(Window.unboundedPreceding, -1))
    extra = ["_blk"] if block_days else []
    out = (u.select(*requests.columns, *extra, "_is_req", F.last("_state", ignorenulls=True).over(w).alias("_s"))
            .filter("_is_req"))
    if carry is not None:
        out = (out.join(carry, keys + ["_blk"], "left")
                  .withColumn("_s", F.coalesce("_s", "_carry")).drop("_carry", "_blk"))
    out = out.select(*requests.columns, *[F.col(f"_s.{f}").alias(f) for f in FEATURES])
    out = out.withColumn("history_rows", F.coalesce("history_rows", F.lit(0)))
    return out.withColumn("history_ok", F.col("history_rows") >= min_history)
