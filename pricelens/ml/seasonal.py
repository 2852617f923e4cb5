"""Seasonal log-price model per commodity.

Re-aimed additive model: log1p(daily mean price) = piecewise-linear trend
(hinges at changepoints spread over the first 80 % of the history) + yearly
Fourier terms (order 10) + weekly Fourier terms (order 3).  The changepoints are
sparse: their coefficients have an L1 penalty, the seasonal terms an L2 penalty
(a Laplace and a normal prior).  The normal equations are summed over the days by
Spark and solved per commodity by coordinate descent; the forecast adds ``horizon`` days, an interval of +-z * residual std, ``expm1`` and a clamp at
0.  Components are the partial sums of the fitted terms.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUT_SCHEMA = ("commodity string, date date, actual double, yhat double, yhat_lower double, yhat_upper double, "
              "trend double, yearly double, weekly double, is_forecast boolean")


def _design(t_days, dow, doy, cps, yearly_order=10, weekly_order=3):
    cols = [np.ones_like(t_days), t_days]
    cols += [np.maximum(t_days - c, 0.0) for c in cps]
    ntrend = len(cols)
    for k in range(1, yearly_order + 1):
        a = 2 * np.pi * k * doy / 365.25
        cols += [np.sin(a), np.cos(a)]
    ny = 2 * yearly_order
    for k in range(1, weekly_order + 1):
        a = 2 * np.pi * k * dow / 7.0
        cols += [np.sin(a), np.cos(a)]
    return np.column_stack(cols), ntrend, ny


def _days(dates: pd.Series, origin: pd.Series, span: pd.Series, n_changepoints: int):
    d = pd.to_datetime(dates)
    t = (d - pd.to_datetime(origin)).dt.days.to_numpy(dtype="float64") / span.to_numpy(dtype="float64")
    return _design(t, d.dt.dayofweek.to_numpy(dtype="float64"), d.dt.dayofyear.to_numpy(dtype="float64"), np.linspace(0, 0.8, n_changepoints + 2)[1:-1])


def _sums(daily: DataFrame, n_changepoints: int) -> DataFrame:
    """(commodity, i, v): the entries of [X y]'[X y], summed over the days in Spark."""
    def run(batches):
        for pdf in batches:
            x, _, _ = _days(pdf["date"], pdf["origin"], pdf["span"], n_changepoints)
            z = np.column_stack([x, np.log1p(pdf["price"].to_numpy(dtype="float64"))])
            for name, at in pdf.groupby("commodity").indices.items():
                g = (z[at].T @ z[at]).ravel()
                yield pd.DataFrame({"commodity": name, "i": np.arange(len(g)), "v": g})

    parts = daily.select("commodity", "date", "price", "origin", "span").mapInPandas(run, "commodity string, i int, v double")
    return parts.groupBy("commodity", "i").agg(F.sum("v").alias("v"))


def elastic_net(xx: np.ndarray, xy: np.ndarray, l1: np.ndarray, l2: np.ndarray, sweeps: int = 20_000, tol: float = 1e-10) -> np.ndarray:
    """Coefficients that minimise b'xx b / 2 - xy'b + sum(l1 |b|) + sum(l2 b^2) / 2, one at a time until none moves."""
    b = np.linalg.solve(xx + np.diag(l2 + 1e-9 * np.diag(xx)), xy)
    left = xy - xx @ b
    size = np.diag(xx) + l2
    scale = np.abs(xy).max() + 1e-300
    for _ in range(sweeps):
        most = 0.0
        for j in np.flatnonzero(size > 0):
            rho = left[j] + xx[j, j] * b[j]
            new = np.sign(rho) * max(abs(rho) - l1[j], 0.0) / size[j]
            if new != b[j]:
                left -= xx[:, j] * (new - b[j])
                most = max(most, abs(new - b[j]) * size[j])
                b[j] = new
        if most <= tol * scale:
            break
    return b


def _solve_fn(n_changepoints, changepoint_scale, seasonal_scale):
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        g = pdf.sort_values("i")["v"].to_numpy()
        k = int(round(len(g) ** 0.5))
        g = g.reshape(k, k)
        xx, xy, yy, n = g[:-1, :-1], g[:-1, -1], g[-1, -1], g[0, 0]

        def variance(beta):
            # residual sum and sum of squares from the same sums; column 0 is 1
            e1, e2 = xy[0] - xx[0] @ beta, yy - 2 * beta @ xy + beta @ xx @ beta
            return max((e2 - e1 * e1 / n) / (n - 1), 0.0) if n > 2 else 0.0
        hinges, terms = slice(2, 2 + n_changepoints), slice(2 + n_changepoints, None)
        l1, l2 = np.zeros(k - 1), np.full(k - 1, 1e-9 * n)
        l2[0] = 0.0
        noise, size = max(variance(np.linalg.solve(xx + np.diag(l2 + 1e-9 * np.diag(xx)), xy)), 1e-12), max(yy / n, 1e-12) ** 0.5
        l1[hinges] = noise / (changepoint_scale * size)
        l2[terms] = noise / (seasonal_scale * size) ** 2
        beta = elastic_net(xx, xy, l1, l2)
        return pd.DataFrame({"commodity": [pdf["commodity"].iloc[0]], "beta": [beta.tolist()], "sd": [variance(beta) ** 0.5]})
    return solve


def _score_fn(z, n_changepoints):
    def score(batches):
        for pdf in batches:
            x, ntr, ny = _days(pdf["date"], pdf["origin"], pdf["span"], n_changepoints)
            b = np.array([v if v is not None else np.zeros(x.shape[1]) for v in pdf["beta"]], dtype="float64").reshape(len(pdf), x.shape[1])
            part = x * b
            yhat, sd = part.sum(axis=1), pdf["sd"].fillna(0.0).to_numpy()
            yield pd.DataFrame({
                "commodity": pdf["commodity"], "date": pdf["date"], "actual": pdf["price"],
                "yhat": np.maximum(np.expm1(yhat), 0.0), "yhat_lower": np.maximum(np.expm1(yhat - z * sd), 0.0),
                "yhat_upper": np.maximum(np.expm1(yhat + z * sd), 0.0), "trend": part[:, :ntr].sum(axis=1),
                "yearly": part[:, ntr:ntr + ny].sum(axis=1), "weekly": part[:, ntr + ny:].sum(axis=1), "is_forecast": pdf["is_forecast"]})
    return score


def seasonal_forecast(panel: DataFrame, horizon: int = 30, n_changepoints: int = 25, changepoint_scale: float = 0.01,
                      seasonal_scale: float = 10.0, z: float = 1.2816, train_end=None) -> DataFrame:
    """History fit + ``horizon`` future days per commodity (positive prices only, P15).

    ``changepoint_scale`` and ``seasonal_scale`` are the priors' scales as shares of
    the log prices' size.  ``z`` = 1.2816 gives an 80 % interval.  ``train_end`` fits only on dates
    before it (M20 out-of-sample evaluation).  The normal equations are sums over
    the days, so a task never holds a whole series; only the solution of one
    commodity's fixed-size system runs in one place.
    """
    from pricelens.operators.stats import broadcast_if_small
    from pricelens.session import ship_package
    ship_package(panel.sparkSession)
    daily = (panel.filter(F.col("modal_price") > 0)
                  .groupBy("commodity", "date").agg(F.avg("modal_price").alias("price")))
    fits = F.lit(True) if train_end is None else F.col("date") < F.lit(train_end)
    known = daily.groupBy("commodity").agg(F.min("date").alias("origin"), F.max("date").alias("last"), F.max(F.when(fits, F.col("date"))).alias("fit_last"))
    known = known.select("commodity", "origin", "last", F.greatest(F.coalesce(F.datediff("fit_last", "origin"), F.lit(1)), F.lit(1)).alias("span"))
    rows = daily.join(broadcast_if_small(known.drop("last")), "commodity")
    beta = _sums(rows.filter(fits), n_changepoints).groupBy("commodity").applyInPandas(_solve_fn(n_changepoints, changepoint_scale, seasonal_scale), "commodity string, beta array<double>, sd double")
    rows = rows.withColumn("is_forecast", F.lit(False))
    if horizon:
        ahead = known.select("commodity", F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", horizon))).alias("date"), F.lit(None).cast("double").alias("price"), "origin", "span", F.lit(True).alias("is_forecast"))
        rows = rows.select(*ahead.columns).unionByName(ahead)
    rows = rows.join(broadcast_if_small(beta), "commodity", "left")
    return rows.select("commodity", "date", "price", "origin", "span", "is_forecast", "beta", "sd").mapInPandas(_score_fn(z, n_changepoints), OUT_SCHEMA)


def seasonal_evaluation(fc: DataFrame, train_end) -> DataFrame:
    """MAE/RMSE/MAPE in-sample (before ``train_end``) and out-of-sample."""
    h = fc.filter(~F.col("is_forecast")).withColumn(
        "sample", F.when(F.col("date") < F.lit(train_end), "in_sample").otherwise("out_of_sample"))
    e = F.col("actual") - F.col("yhat")
    return h.groupBy("commodity", "sample").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(e, F.col("actual")))) * 100).alias("mape"))
