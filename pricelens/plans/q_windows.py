"""Window-feature queries (W1-W14) and the as-of lookup (J12) on the price panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.functions import q4
from pricelens.operators import windows as W
from pricelens.operators.asof import asof_features
from pricelens.operators.scores import price_stress
from pricelens.plans.registry import QUERIES, register
from pricelens.plans.sqlviews import q4 as sq4, with_views
from pricelens.sources.adapter import price_panel, price_requests

K = ("commodity", "district")


def _q(df, names):
    return df.select(*[q4(c).alias(c) if c in names else F.col(c) for c in df.columns])


_WK = "PARTITION BY commodity, district ORDER BY date"


def _roll_sql(x, n, incl, m):
    frame = f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW" if incl else f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING"
    return (f"CASE WHEN COUNT({x}) OVER (w {frame}) >= {m} "
            f"THEN AVG({x}) OVER (w {frame}) END")


@register("history_features", "W1 W6 W8 W9 D1", sql=with_views(["price_panel"], f"""
SELECT commodity, district, date,
  {sq4('modal_price')} AS modal_price,
  {sq4('lag(modal_price, 1) OVER w')} AS lag_1,
  {sq4('lag(modal_price, 2) OVER w')} AS lag_2,
  {sq4('lag(modal_price, 3) OVER w')} AS lag_3,
  {sq4(_roll_sql('modal_price', 7, False, 7))} AS rolling_7,
  {sq4(_roll_sql('modal_price', 30, False, 30))} AS rolling_30,
  {sq4('modal_price - lag(modal_price, 1) OVER w')} AS price_change,
  {sq4('(modal_price / NULLIF(lag(modal_price, 1) OVER w, 0) - 1) * 100')} AS price_change_pct,
  CASE WHEN abs((modal_price / NULLIF(lag(modal_price, 1) OVER w, 0) - 1) * 100) >= 30 THEN 3
       WHEN abs((modal_price / NULLIF(lag(modal_price, 1) OVER w, 0) - 1) * 100) >= 20 THEN 2
       WHEN abs((modal_price / NULLIF(lag(modal_price, 1) OVER w, 0) - 1) * 100) >= 10 THEN 1
       ELSE 0 END AS price_stress
FROM price_panel
WINDOW w AS ({_WK})
"""))
def history_features(spark, sf_dir):
    p = price_panel(spark, sf_dir).select(*K, "date", "modal_price")
    f = W.add_history_features(p, K, "date", "modal_price", (1, 2, 3), (7, 30),
                               include_current=False)
    f = W.add_change_features(f, K, "date", "modal_price")
    f = f.withColumn("price_stress", price_stress(F.abs("price_change_pct")))
    return _q(f, {"modal_price", "lag_1", "lag_2", "lag_3", "rolling_7", "rolling_30",
                  "price_change", "price_change_pct"})


# J12 ---------------------------------------------------------------------------------

_ASOF_SQL = with_views(["price_panel", "daily_signal"], f"""
SELECT r.date, r.district, r.commodity, {sq4('h.lag_1')} AS lag_1, {sq4('h.lag_2')} AS lag_2, {sq4('h.lag_3')} AS lag_3,
       {sq4('h.rolling_7')} AS rolling_7, {sq4('h.rolling_30')} AS rolling_30,
       CAST(COALESCE(h.history_rows, 0) AS INTEGER) AS history_rows, COALESCE(h.history_rows, 0) >= 30 AS history_ok
FROM req r ASOF LEFT JOIN hist h ON r.commodity = h.commodity AND r.district = h.district AND r.date > h.date""",
    [("req", "SELECT d.date, d.district, k.commodity FROM daily_signal d JOIN (SELECT DISTINCT commodity, district FROM price_panel) k ON d.district = k.district"),
     ("hist", """SELECT commodity, district, date, modal_price AS lag_1,
        lag(modal_price, 1) OVER w AS lag_2, lag(modal_price, 2) OVER w AS lag_3,
        CASE WHEN count(modal_price) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) >= 7
             THEN avg(modal_price) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END AS rolling_7,
        CASE WHEN count(modal_price) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) >= 30
             THEN avg(modal_price) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) END AS rolling_30,
        row_number() OVER w AS history_rows
      FROM price_panel WINDOW w AS (PARTITION BY commodity, district ORDER BY date)""")])


@register("asof_history_features", "J12 W1 W5 U2", sql=_ASOF_SQL)
def q_asof_history_features(spark, sf_dir):
    req = price_requests(spark, sf_dir).select("date", "district", "commodity")
    # requests spread over (key, 90-day block) partitions; history state carried across blocks
    f = asof_features(req, price_panel(spark, sf_dir), K, "date", "modal_price", 30, block_days=90)
    return _q(f, {"lag_1", "lag_2", "lag_3", "rolling_7", "rolling_30"})


# W13 / W14 / M13 -------------------------------------------------------------------
@register("row_rank_split", "W13 M3", sql=with_views(["price_panel"], """
SELECT commodity, CAST(COUNT(*) FILTER (WHERE rn <= floor(0.8 * n)) AS BIGINT) AS train_rows,
       CAST(COUNT(*) FILTER (WHERE rn > floor(0.8 * n)) AS BIGINT) AS test_rows,
       MAX(date) FILTER (WHERE rn <= floor(0.8 * n)) AS last_train_date
FROM (SELECT commodity, date, row_number() OVER (PARTITION BY commodity ORDER BY date, district) AS rn,
             COUNT(*) OVER (PARTITION BY commodity) AS n FROM price_panel)
GROUP BY 1"""))
def q_row_rank_split(spark, sf_dir):
    r = W.row_rank_split(price_panel(spark, sf_dir), ["commodity"], ["date", "district"], 0.8)
    return r.groupBy("commodity").agg(F.count_if("is_train").alias("train_rows"),
                                      F.count_if(~F.col("is_train")).alias("test_rows"),
                                      F.max(F.when(F.col("is_train"), F.col("date"))).alias("last_train_date"))


_CMP_FEATS = ["rolling_7", "rolling_30"]


@register("feature_recheck", "W14 W5 W6", sql=with_views(["price_panel"], " UNION ALL ".join(f"""
SELECT '{f}' AS feature, CAST(COUNT(*) AS BIGINT) AS rows,
  CAST(COUNT(*) FILTER (WHERE (s IS NULL AND r IS NULL) OR coalesce(abs(s - r) <= 1e-8 + 1e-5 * abs(r), false)) AS BIGINT) AS n_close,
  CAST(COUNT(*) FILTER (WHERE abs(s - r) < 0.01) AS BIGINT) AS n_within_tol,
  {sq4('AVG(abs(s - r))')} AS mean_abs_diff, {sq4('MAX(abs(s - r))')} AS max_abs_diff
FROM (SELECT {_roll_sql('modal_price', int(f.split('_')[1]), False, 1)} AS s,
             {_roll_sql('modal_price', int(f.split('_')[1]), False, int(f.split('_')[1]))} AS r
      FROM price_panel WINDOW w AS ({_WK}))""" for f in _CMP_FEATS)))
def q_feature_recheck(spark, sf_dir):
    """Stored stage features (rolling means with min_periods=1) against the
    recomputed full-window features: agreement counts per feature."""
    p = price_panel(spark, sf_dir)
    a = W.add_history_features(p, lags=(), windows=(7, 30), include_current=False, min_periods=1, prefix="s_")
    a = W.add_history_features(a, lags=(), windows=(7, 30), include_current=False, prefix="r_")
    c = W.compare_features(a, {f: (f"s_{f}", f"r_{f}") for f in _CMP_FEATS})
    return c.select("feature", "rows", "n_close", "n_within_tol", q4("mean_abs_diff").alias("mean_abs_diff"),
                    q4("max_abs_diff").alias("max_abs_diff"))


_LEAK = ["lag_1", "lag_2", "lag_3", "rolling_7", "rolling_30", "price_change"]


def _corr_sql(a, b):
    pa = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a} END"
    pb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {b} END"
    return f"(covar_samp({pa}, {pb}) / NULLIF(stddev_samp({pa}) * stddev_samp({pb}), 0))"


_LF = f"""SELECT modal_price, lag(modal_price, 1) OVER w AS lag_1, lag(modal_price, 2) OVER w AS lag_2,
  lag(modal_price, 3) OVER w AS lag_3, {_roll_sql('modal_price', 7, False, 7)} AS rolling_7,
  {_roll_sql('modal_price', 30, False, 30)} AS rolling_30, modal_price - lag(modal_price, 1) OVER w AS price_change
FROM price_panel WINDOW w AS ({_WK})"""


@register("leakage_report", "M13 A7 W1 W6 W8", sql=with_views(["price_panel"], " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {sq4(_corr_sql(f, 'modal_price'))} AS correlation_with_target, "
    f"{'true' if f == 'price_change' else 'false'} AS leaks_target FROM lf" for f in _LEAK), [("lf", _LF)]))
def q_leakage_report(spark, sf_dir):
    """Correlation of each history feature with the target; ``price_change``
    is computed from the target itself and is dropped from model inputs."""
    from pricelens.functions import safe_corr
    p = price_panel(spark, sf_dir)
    f = W.add_change_features(W.add_history_features(p))
    agg = f.agg(*[safe_corr(c, "modal_price").alias(c) for c in _LEAK])
    long = agg.unpivot([], _LEAK, "feature", "correlation_with_target")
    return long.select("feature", q4("correlation_with_target").alias("correlation_with_target"),
                       (F.col("feature") == "price_change").alias("leaks_target"))


@register("history_features_blocked", "W1 W6 W8 W9 D1 (time-blocked windows)",
          sql=QUERIES["history_features"].sql)
def q_history_features_blocked(spark, sf_dir):
    """Same result as ``history_features``; windows run per (key, 90-day block)
    with a 30-row look-back copied in, so long series spread over many tasks."""
    p = price_panel(spark, sf_dir).select(*K, "date", "modal_price")
    f = W.blocked_history_features(p, K, "date", "modal_price", (1, 2, 3), (7, 30),
                                   include_current=False, block_days=90)
    from pricelens.functions import pct_change
    f = f.withColumns({"price_change": F.col("modal_price") - F.col("lag_1"),
                       "price_change_pct": pct_change("modal_price", "lag_1")})
    f = f.withColumn("price_stress", price_stress(F.abs("price_change_pct")))
    return _q(f, {"modal_price", "lag_1", "lag_2", "lag_3", "rolling_7", "rolling_30",
                  "price_change", "price_change_pct"})


@register("legacy_stage_features", "W4 W8", sql=with_views(["price_panel"], f"""
SELECT commodity, district, date, {sq4('modal_price')} AS modal_price,
  {sq4(_roll_sql('modal_price', 7, True, 7))} AS rolling_7,
  {sq4(_roll_sql('modal_price', 30, True, 30))} AS rolling_30,
  {sq4('modal_price - lag(modal_price, 1) OVER w')} AS price_change
FROM price_panel WINDOW w AS ({_WK})"""))
def q_legacy_stage_features(spark, sf_dir):
    """Stage-3 features: trailing means *including* the current row, full
    window required (NULL before 7 / 30 rows), and the first difference."""
    p = price_panel(spark, sf_dir).select(*K, "date", "modal_price")
    f = W.add_history_features(p, K, "date", "modal_price", (), (7, 30), include_current=True)
    f = f.withColumn("price_change", F.col("modal_price") - W.lag("modal_price", 1, W.spec(K, "date")))
    return _q(f, {"modal_price", "rolling_7", "rolling_30", "price_change"})
