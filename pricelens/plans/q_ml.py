"""Model queries.

Queries with a model in them have no SQL oracle (rows-only check); the split
boundary, the naive-baseline metrics and the price categories do.
Models are fitted at the reference's settings (``regress.MODEL_SPECS`` and the
settings beside each learner), each once per input snapshot
(``store.materialized_model``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.functions import q4
from pricelens.ml import classify as CL
from pricelens.ml import cluster as KM
from pricelens.ml import data as D
from pricelens.ml import iforest as IF
from pricelens.ml import regress as R
from pricelens.ml import seasonal as SE
from pricelens.ml.forecast import recursive_forecast
from pricelens.ml.metrics import confusion_matrix, regression_metrics
from pricelens.operators import intelligence as I
from pricelens.operators.panel import panel_with_weather
from pricelens.operators.scores import event_type, shock_type
from pricelens.plans.registry import register
from pricelens.plans.sqlviews import q4 as sq4, with_views
from pricelens.sources.adapter import price_panel, price_requests


def _qall(df):
    dbl = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*[q4(c).alias(c) if c in dbl else F.col(c) for c in df.columns])


SPLIT_SQL = """SELECT (SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i FROM (SELECT DISTINCT date FROM price_panel))
        WHERE i = (SELECT floor(COUNT(DISTINCT date) * 0.8) FROM price_panel)) AS split_date"""


@register("chrono_split_boundary", "M3 A11 U3", sql=with_views(["price_panel"], """
SELECT s.split_date, CAST(COUNT(*) FILTER (WHERE p.date < s.split_date) AS BIGINT) AS train_rows,
       CAST(COUNT(*) FILTER (WHERE p.date >= s.split_date) AS BIGINT) AS test_rows,
       MAX(p.date) FILTER (WHERE p.date < s.split_date) AS last_train_date,
       MIN(p.date) FILTER (WHERE p.date >= s.split_date) AS first_test_date,
       MAX(p.date) FILTER (WHERE p.date < s.split_date) >= MIN(p.date) FILTER (WHERE p.date >= s.split_date) AS overlap
FROM price_panel p, split s GROUP BY s.split_date""", [("split", SPLIT_SQL)]))
def q_chrono_split_boundary(spark, sf_dir):
    p = price_panel(spark, sf_dir)
    sd = D.split_date_by_fraction(p)
    from pricelens.operators.stats import attach
    j = attach(p, sd)
    lt = F.col("date") < F.col("split_date")
    g = j.groupBy("split_date").agg(F.count_if(lt).alias("train_rows"), F.count_if(~lt).alias("test_rows"),
                                    F.max(F.when(lt, F.col("date"))).alias("last_train_date"),
                                    F.min(F.when(~lt, F.col("date"))).alias("first_test_date"))
    return g.withColumn("overlap", F.col("last_train_date") >= F.col("first_test_date"))


def _naive_sql():
    base = """SELECT p.commodity, p.district, p.modal_price AS y, p.lag_1 AS yhat FROM (
        SELECT *, lag(modal_price) OVER (PARTITION BY commodity, district ORDER BY date) AS lag_1 FROM price_panel) p, split s
      WHERE p.date >= s.split_date AND p.lag_1 IS NOT NULL"""
    def part(kind, key):
        return f"""SELECT '{kind}' AS slice_type, {key} AS slice, CAST(COUNT(*) AS BIGINT) AS rows,
          {sq4('AVG(abs(y - yhat))')} AS mae, {sq4('sqrt(AVG((y - yhat) * (y - yhat)))')} AS rmse,
          {sq4('CASE WHEN COUNT(*) > 1 THEN 1 - SUM((y - yhat) * (y - yhat)) / NULLIF(COUNT(*) * var_pop(y), 0) END')} AS r2
          FROM t GROUP BY {key if key != "'all'" else "1"} HAVING COUNT(*) >= 10"""
    return with_views(["price_panel"], " UNION ALL ".join(
        [part("overall", "'all'"), part("commodity", "commodity"), part("district", "district")]),
        [("split", SPLIT_SQL), ("t", base)])


@register("naive_baseline_metrics", "M8 M9 M3", sql=_naive_sql())
def q_naive_baseline_metrics(spark, sf_dir):
    from pricelens.operators.windows import lag, spec
    p = price_panel(spark, sf_dir)
    p = p.withColumn("prediction", lag("modal_price", 1, spec(["commodity", "district"], "date")))
    _, test = D.chrono_split(p, "date_fraction")
    test = test.filter(F.col("prediction").isNotNull())
    parts = []
    for kind, key in [("overall", None), ("commodity", "commodity"), ("district", "district")]:
        keys = [key] if key else []
        m = regression_metrics(test, "modal_price", "prediction", keys, min_rows=10)
        parts.append(m.select(F.lit(kind).alias("slice_type"),
                              (F.col(key) if key else F.lit("all")).alias("slice"), "rows", "mae", "rmse", "r2"))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return _qall(out)


@register("price_category", "D16 A10", sql=with_views(["price_panel"], f"""
SELECT p.commodity, p.district, p.date, {sq4('p.modal_price')} AS modal_price, {sq4('b.p33')} AS p33, {sq4('b.p66')} AS p66,
  CASE WHEN p.modal_price <= b.p33 THEN 'Cheap' WHEN p.modal_price <= b.p66 THEN 'Normal' ELSE 'Expensive' END AS price_category
FROM price_panel p JOIN (SELECT commodity, quantile_cont(modal_price, 0.33) AS p33, quantile_cont(modal_price, 0.66) AS p66
                         FROM price_panel GROUP BY 1) b ON p.commodity = b.commodity"""))
def q_price_category(spark, sf_dir):
    c = CL.price_category(price_panel(spark, sf_dir))
    return _qall(c.select("commodity", "district", "date", "modal_price", "p33", "p66", "price_category"))


@register("price_category_counts", "D16 A2", sql=with_views(["price_panel"], """
SELECT p.commodity, CASE WHEN p.modal_price <= b.p33 THEN 'Cheap' WHEN p.modal_price <= b.p66 THEN 'Normal' ELSE 'Expensive' END AS price_category,
       CAST(COUNT(*) AS BIGINT) AS n
FROM price_panel p JOIN (SELECT commodity, quantile_cont(modal_price, 0.33) AS p33, quantile_cont(modal_price, 0.66) AS p66
                         FROM price_panel GROUP BY 1) b ON p.commodity = b.commodity GROUP BY 1, 2"""))
def q_price_category_counts(spark, sf_dir):
    c = CL.price_category(price_panel(spark, sf_dir))
    return c.groupBy("commodity", "price_category").agg(F.count(F.lit(1)).alias("n"))


# -- regressors ------------------------------------------------------------------
def _split(spark, sf_dir):
    mp = D.model_panel(spark, sf_dir)
    return D.chrono_split(mp, "date_fraction")


def _model(spark, sf_dir, name, on="train"):
    """A registered model fitted on the training split or on the whole panel, stored once."""
    from pricelens.sources.store import materialized_model
    from pricelens.sources.tables import table_path

    def fit():
        rows = _split(spark, sf_dir)[0] if on == "train" else D.model_panel(spark, sf_dir)
        return R.fit(rows, R.MODEL_SPECS[name])
    return materialized_model(spark, f"{name}_{on}", [table_path(sf_dir, t) for t in _STAGE_TABLES], fit)


def _comparison(spark, sf_dir):
    """Metrics of every compared model on the test split, stored once."""
    def build():
        train, test = _split(spark, sf_dir)
        df, _ = R.compare_models(train, test, R.MODEL_SPECS, lambda name: _model(spark, sf_dir, name))
        return df.withColumn("train_rows", F.lit(train.count()).cast("long"))
    return _stage(spark, sf_dir, "model_metrics", build)


@register("ml_model_comparison", "M4 M5 M8 M11 M3 M1")
def q_ml_model_comparison(spark, sf_dir):
    df = _comparison(spark, sf_dir)
    best = {rule: R.select_model(df, rule) for rule in R.SELECTION_RULES}
    out = df.withColumns({"selected": F.col("model") == best["mae_rmse_r2"],
                          "selected_by_r2": F.col("model") == best["higher_r2"], "selected_by_mae": F.col("model") == best["lower_mae"]})
    return _qall(out)


@register("ml_run_log", "M25")
def q_ml_run_log(spark, sf_dir):
    """The run summary rows written to a run-log table and read back."""
    import uuid

    from pricelens.session import checkpoint_dir
    from pricelens.sources.sinks import append_run_log
    path = f"{checkpoint_dir(spark).rstrip('/')}/pricelens_runs/{uuid.uuid4().hex}"
    append_run_log(q_ml_model_comparison(spark, sf_dir).select("model", "mae", "rmse", "r2", "train_rows", "test_rows"), path)
    return spark.read.parquet(path).drop("logged_at")


def _selected_model(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    return _model(spark, sf_dir, _selected(spark, sf_dir)), train, test


def _selected(spark, sf_dir) -> str:
    """Name of the model that the final rule selects."""
    return R.select_model(_comparison(spark, sf_dir))


@register("ml_metrics_by_slice", "M9 M23")
def q_ml_metrics_by_slice(spark, sf_dir):
    model, _, test = _selected_model(spark, sf_dir)
    pred = R.predict(model, test)
    c = regression_metrics(pred, keys=["commodity"], min_rows=10).withColumn("slice_type", F.lit("commodity")) \
        .withColumnRenamed("commodity", "slice")
    d = regression_metrics(pred, keys=["district"], min_rows=10).withColumn("slice_type", F.lit("district")) \
        .withColumnRenamed("district", "slice")
    return _qall(c.unionByName(d))


@register("ml_top_importances", "L4 M12")
def q_ml_top_importances(spark, sf_dir):
    """The ten most important features (the limit is the feature)."""
    return q_ml_feature_importance(spark, sf_dir).orderBy(F.desc("importance"), "feature").limit(10)


@register("ml_feature_importance", "M12 M13")
def q_ml_feature_importance(spark, sf_dir):
    model, _, _ = _selected_model(spark, sf_dir)
    return _qall(R.feature_importance(model))


def _model_forecast(spark, sf_dir, horizon=30):
    """Recursive model forecast for every key, stored once as a stage table
    (the forecast output the scoring layer consumes)."""
    def build():
        return recursive_forecast(_model(spark, sf_dir, _selected(spark, sf_dir), "panel"), D.model_panel(spark, sf_dir), horizon=horizon)
    return _stage(spark, sf_dir, f"model_forecast_h{horizon}", build)


@register("ml_recursive_forecast", "M15 M14 X20 P20")
def q_ml_recursive_forecast(spark, sf_dir):
    return _qall(_model_forecast(spark, sf_dir))


@register("ml_forecast_intelligence", "D7 D13 M15")
def q_ml_forecast_intelligence(spark, sf_dir):
    fc = _model_forecast(spark, sf_dir)
    s = I.forecast_summary(fc)
    return _qall(s.join(I.best_forecast_district(fc), "commodity"))


# -- clustering --------------------------------------------------------------------
def _profile(spark, sf_dir):
    from pricelens.plans.q_aggregates import district_profile
    return district_profile(panel_with_weather(spark, sf_dir))


@register("district_clusters", "M16 A4")
def q_district_clusters(spark, sf_dir):
    return _qall(KM.cluster_districts(_profile(spark, sf_dir)))


@register("cluster_k_search", "M16")
def q_cluster_k_search(spark, sf_dir):
    return _qall(KM.k_search(_profile(spark, sf_dir)))


@register("cluster_summary", "D11 A25 J8 M16")
def q_cluster_summary(spark, sf_dir):
    from pricelens.plans.q_scores import crisis_frame
    cl = KM.cluster_districts(_profile(spark, sf_dir), KM.WEATHER_MEASURES, k=2)
    di = I.district_intelligence(crisis_frame(spark, sf_dir))
    return _qall(KM.cluster_summary(cl, di))


# -- classifier ----------------------------------------------------------------------
_STAGE_TABLES = ("lineitem", "part", "supplier", "nation", "region", "orders", "customer")


def _stage(spark, sf_dir, name, build):
    from pricelens.sources.store import materialized
    from pricelens.sources.tables import table_path
    return materialized(spark, name, [table_path(sf_dir, t) for t in _STAGE_TABLES], build)


def _classifier(spark, sf_dir):
    """Test-split predictions of the category classifier with class names and
    probabilities, stored once as a stage table (shared by four queries)."""
    def build():
        mp = CL.price_category(D.model_panel(spark, sf_dir))
        train, test = D.chrono_split(mp, "date_fraction")
        pred = CL.classified(CL.fit_classifiers(train), test)
        return pred.select("commodity", "district", "date", "price_category", "predicted_category",
                           "probabilities", "label", "prediction", "probability")
    return _stage(spark, sf_dir, "category_predictions", build)


@register("price_category_classifier", "M7 M10 M24")
def q_price_category_classifier(spark, sf_dir):
    m = CL.classification_metrics(_classifier(spark, sf_dir))
    return spark.createDataFrame([(k, float(v)) for k, v in m.items()], "metric string, value double")


@register("price_category_confusion", "M10 A17 L3")
def q_price_category_confusion(spark, sf_dir):
    return confusion_matrix(_classifier(spark, sf_dir), "price_category", "predicted_category", CL.CLASSES)


# -- isolation forest ------------------------------------------------------------------
OUTLIER_FEATURES = ["modal_price", "price_change_pct", "price_deviation", "arrival", "arrival_deviation"]


def _outliers(spark, sf_dir, trees=200):
    """Crisis rows scored by the isolation forest, stored once as a stage table."""
    from pricelens.plans.q_scores import crisis_frame

    def build():
        c = crisis_frame(spark, sf_dir)
        o = IF.isolation_forest(c, "commodity", OUTLIER_FEATURES, ["commodity", "district", "date"], trees=trees)
        return o.withColumns({"event_type": event_type(F.col("outlier_flag") == -1),
                              "shock_type": shock_type(F.col("outlier_flag") == -1,
                                                       F.coalesce("price_zscore", F.lit(0.0)),
                                                       F.coalesce("arrival_zscore", F.lit(0.0)))})
    return _stage(spark, sf_dir, f"outliers_t{trees}", build)


@register("outlier_events", "M18 D15 W10")
def q_outlier_events(spark, sf_dir):
    o = _outliers(spark, sf_dir).filter(F.col("outlier_flag") == -1)
    return _qall(o.select("date", "commodity", "district", "modal_price", "arrival", "price_change_pct",
                          "price_zscore", "arrival_zscore", "anomaly_score", "decision", "outlier_flag",
                          "event_type", "shock_type"))


@register("outlier_summary", "M18 D15 A2 A14")
def q_outlier_summary(spark, sf_dir):
    o = _outliers(spark, sf_dir)
    return _qall(o.groupBy("commodity").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("outlier_flag") == -1).alias("anomalies"),
        (F.avg((F.col("outlier_flag") == -1).cast("double")) * 100).alias("anomaly_pct")))


# -- seasonal ----------------------------------------------------------------------------
@register("seasonal_forecast", "M19 M21 P15")
def q_seasonal_forecast(spark, sf_dir):
    return _qall(SE.seasonal_forecast(price_panel(spark, sf_dir)))


@register("seasonal_evaluation", "M20 M3 M8")
def q_seasonal_evaluation(spark, sf_dir):
    p = price_panel(spark, sf_dir)
    cut = D.split_date_by_fraction(p).first().split_date
    fc = SE.seasonal_forecast(p, horizon=0, train_end=cut)
    return _qall(SE.seasonal_evaluation(fc, cut))


# -- request scoring -----------------------------------------------------------------------
@register("batch_request_scoring", "M22 J12 J13")
def q_batch_request_scoring(spark, sf_dir):
    from pricelens.ml.serve import score_requests
    model = _model(spark, sf_dir, _selected(spark, sf_dir), "panel")
    from pricelens.plans.q_scores import _forecast, _reco
    req = price_requests(spark, sf_dir)
    intel = _reco(spark, sf_dir).select("commodity", "district", "farmer_intelligence_score", "final_risk_level",
                                        "district_risk_level", "recommendation", "recommended_action")
    out = score_requests(req, price_panel(spark, sf_dir), model, intel=intel, forecast=_forecast(spark, sf_dir))
    return _qall(out.select("date", "district", "commodity", "lag_1", "rolling_7", "rolling_30", "history_rows",
                            "error", "predicted_price", "farmer_intelligence_score", "final_risk_level",
                            "district_risk_level", "recommended_action", F.size("forecast_30d").alias("forecast_days"),
                            F.col("forecast_30d")[0]["predicted_price"].alias("forecast_next_day")))


def _per_commodity(spark, sf_dir):
    """Test predictions of one boosted model per commodity on a seeded 80/20 random split, stored once."""
    from pricelens.ml.commodity_forecast import PER_COMMODITY

    def build():
        train, test = D.random_split(D.model_panel(spark, sf_dir))
        return R.per_key_models(train, test, "commodity", PER_COMMODITY).select(*R.ROW, D.TARGET, "prediction")
    return _stage(spark, sf_dir, "per_commodity_predictions", build)


@register("ml_per_commodity_models", "M6 M9 M2")
def q_ml_per_commodity_models(spark, sf_dir):
    """Metrics per commodity of models fitted together, one for each commodity."""
    return _qall(regression_metrics(_per_commodity(spark, sf_dir), keys=["commodity"]))


@register("ml_side_by_side", "M23")
def q_ml_side_by_side(spark, sf_dir):
    """Predictions of two models next to each other on the full panel."""
    mp = D.model_panel(spark, sf_dir)
    rf, gb = (_model(spark, sf_dir, name) for name in ("random_forest", "boosted_trees"))
    k = R.ROW
    a = rf.transform(mp).select(*k, "modal_price", F.col("prediction").alias("rf_prediction"))
    b = gb.transform(mp).select(*k, F.col("prediction").alias("gbt_prediction"))
    return _qall(a.join(b, k))


@register("date_quantile_split", "A11 M3", sql=with_views(["price_panel"], """
SELECT CAST(to_days(CAST(floor(quantile_cont(epoch_ms(date) / 86400000, 0.8)) AS INTEGER)) + DATE '1970-01-01' AS DATE) AS split_date
FROM price_panel"""))
def q_date_quantile_split(spark, sf_dir):
    p = price_panel(spark, sf_dir)
    return D.date_quantile(p, 0.8)


@register("ml_model_persistence", "S10 M12")
def q_ml_model_persistence(spark, sf_dir):
    """Save the model + metadata to the shared folder, reload it and score:
    one row per key with the largest prediction difference (expected 0)."""
    import uuid

    from pricelens.session import checkpoint_dir
    mp = D.model_panel(spark, sf_dir)
    model = _model(spark, sf_dir, "tuned_boosted_trees")
    path = f"{checkpoint_dir(spark).rstrip('/')}/pricelens_models/{uuid.uuid4().hex}"
    R.save_model(model, path, {"features": R.FEATURE_COLUMNS, "target": D.TARGET, "model": "tuned_boosted_trees"})
    loaded, meta = R.load_model(spark, path)
    k = ["commodity", "district", "date"]
    a = model.transform(mp).select(*k, F.col("prediction").alias("p1"))
    b = loaded.transform(mp).select(*k, F.col("prediction").alias("p2"))
    return (a.join(b, k).groupBy("commodity", "district")
             .agg(F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_abs_diff"), F.count(F.lit(1)).alias("rows"))
             .withColumn("model", F.lit(meta["model"])))


@register("ml_commodity_forecast", "M14 M6 W13 M8")
def q_ml_commodity_forecast(spark, sf_dir):
    """Commodity-level recursive 30-day forecast with lags 1-30 and the test
    metrics of its model appended per commodity."""
    return _qall(_commodity_forecast(spark, sf_dir))


def _commodity_forecast(spark, sf_dir):
    from pricelens.ml.commodity_forecast import fit_and_forecast

    def build():
        _, test_pred, fc = fit_and_forecast(price_panel(spark, sf_dir))
        met = regression_metrics(test_pred, keys=["commodity"]).select(
            "commodity", F.col("mae").alias("test_mae"), F.col("rmse").alias("test_rmse"), F.col("r2").alias("test_r2"))
        return fc.join(met, "commodity", "left")
    return _stage(spark, sf_dir, "commodity_forecast", build)


@register("farmer_master_table_models", "D7-D14 M15 M16 M18 J8")
def q_farmer_master_table_models(spark, sf_dir):
    """The full scoring path of the reference: model forecast (recursive, M15),
    isolation-forest abnormal events (M18) in the risk summary, KMeans
    clusters (M16) on the district intelligence, then recommendations and
    the master table with the cluster column."""
    from pricelens.plans.q_scores import crisis_frame
    crisis = crisis_frame(spark, sf_dir)
    fc = _model_forecast(spark, sf_dir)
    outl = _outliers(spark, sf_dir).filter(F.col("outlier_flag") == -1).select("commodity")
    intel = I.farmer_intelligence(I.forecast_summary(fc), I.risk_summary(crisis, outl))
    clusters = KM.cluster_districts(_profile(spark, sf_dir), KM.WEATHER_MEASURES, k=2).select("district", "cluster")
    dintel = I.district_intelligence(crisis).join(clusters, "district", "left")
    pairs = price_panel(spark, sf_dir).select("commodity", "district").distinct()
    reco = I.recommendations(pairs, intel, dintel)
    reco = reco.join(clusters, "district", "left")
    m = reco.join(I.best_forecast_district(fc), "commodity", "left")
    cols = I.MASTER_COLUMNS[:11] + ["cluster"] + I.MASTER_COLUMNS[11:]
    return _qall(m.select(*cols).orderBy("commodity", "district"))


@register("price_category_report", "M10 M24")
def q_price_category_report(spark, sf_dir):
    """Per-class precision / recall / F1 / support of the category classifier."""
    from pricelens.ml.metrics import classification_report
    return _qall(classification_report(_classifier(spark, sf_dir), "price_category", "predicted_category"))


@register("price_category_predictions", "M24 M7")
def q_price_category_predictions(spark, sf_dir):
    """Test rows with the predicted class and the class probabilities next to it."""
    p = _classifier(spark, sf_dir)
    return p.select("commodity", "district", "date", "price_category", "predicted_category", "probabilities")
