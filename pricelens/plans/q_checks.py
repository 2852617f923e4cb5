"""Queries whose SQL checks what the model, serving and sink queries promise."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pricelens.functions import q4
from pricelens.ml import cluster as KM
from pricelens.ml import data as D
from pricelens.ml import regress as R
from pricelens.ml import seasonal as SE
from pricelens.ml.serve import MESSAGES, validate
from pricelens.operators.joins import code_map
from pricelens.operators.windows import lag, spec
from pricelens.plans import q_ml, q_scores  # noqa: F401  (its SQL is nested below)
from pricelens.plans.q_aggregates import district_profile
from pricelens.plans.registry import QUERIES, register
from pricelens.plans.sqlviews import q4 as sq4, with_views
from pricelens.session import checkpoint_dir
from pricelens.sources.adapter import daily_signal, price_panel, price_requests
from pricelens.operators.panel import panel_with_weather

_BAD = """SELECT commodity, district, date, CAST(dayofyear(date) % 9 AS INTEGER) AS kind FROM
  (SELECT DISTINCT commodity, district FROM price_panel) JOIN daily_signal USING (district)"""


@register("request_validation", "M22 (rules; date build)", sql=with_views(["price_panel", "daily_signal"], f"""
SELECT commodity, district, date, kind, CASE kind
  WHEN 0 THEN '{MESSAGES['arrival']}' WHEN 1 THEN '{MESSAGES['rainfall']}' WHEN 2 THEN '{MESSAGES['wind']}'
  WHEN 3 THEN '{MESSAGES['month']}' WHEN 4 THEN '{MESSAGES['day']}' WHEN 5 THEN '{MESSAGES['date']}'
  WHEN 6 THEN '{MESSAGES['unknown']}' END AS error FROM bad""", [("bad", _BAD)]))
def q_request_validation(spark, sf_dir):
    """Every request given one fault by its day of the year, or none, as form fields."""
    r = price_requests(spark, sf_dir).withColumn("kind", (F.dayofyear("date") % 9).cast("int"))
    k = F.col("kind")
    own = r.withColumnsRenamed({"commodity": "asked", "date": "asked_date"})
    own = own.withColumns({
        "commodity": F.when(k == 6, "no such crop").otherwise(F.col("asked")),
        "arrival": F.when(k == 0, F.lit(-1.0)).otherwise(F.col("arrival")),
        "rainfall_mm": F.when(k == 1, F.lit(-0.5)).otherwise(F.col("rainfall_mm")),
        "wind": F.when(k == 2, F.lit(-3.0)).otherwise(F.col("wind")),
        "year": F.year("asked_date"),
        "month": F.when(k == 3, 13).when(k == 5, 4).otherwise(F.month("asked_date")),
        "day": F.when(k == 4, 32).when(k == 5, 31).otherwise(F.dayofmonth("asked_date"))})
    v = validate(own, price_panel(spark, sf_dir).select("commodity", "district").distinct())
    return v.select(F.col("asked").alias("commodity"), "district", F.col("asked_date").alias("date"), "kind", "error")


@register("scored_prediction_sink", "S11", sql=with_views(["price_panel"], f"""
SELECT commodity, district, date, {sq4('modal_price')} AS modal_price, {sq4('prediction')} AS prediction, {sq4('modal_price - prediction')} AS error
FROM (SELECT *, lag(modal_price) OVER (PARTITION BY commodity, district ORDER BY date) AS prediction FROM price_panel) p, split s
WHERE date >= split_date AND prediction IS NOT NULL""", [("split", q_ml.SPLIT_SQL)]))
def q_scored_prediction_sink(spark, sf_dir):
    """Predictions with residuals written as a table and read back."""
    from pricelens.sources.sinks import write_predictions
    p = price_panel(spark, sf_dir).withColumn("prediction", lag("modal_price", 1, spec(["commodity", "district"], "date")))
    _, test = D.chrono_split(p, "date_fraction")
    path = f"{checkpoint_dir(spark).rstrip('/')}/pricelens_predictions/{uuid.uuid4().hex}"
    write_predictions(test.filter(F.col("prediction").isNotNull()), path)
    return spark.read.parquet(path).select("commodity", "district", "date", *[q4(c).alias(c) for c in ("modal_price", "prediction", "error")])


@register("encoder_policies", "M1 J16", sql=with_views(["price_panel", "daily_signal"], """
SELECT w.district, CAST(coalesce(c.code, -1) AS INTEGER) AS code, coalesce(c.district, (SELECT min(district) FROM price_panel WHERE district <> 'ASIA')) AS first_class
FROM (SELECT DISTINCT district FROM daily_signal) w LEFT JOIN
  (SELECT district, row_number() OVER (ORDER BY district) - 1 AS code FROM (SELECT DISTINCT district FROM price_panel WHERE district <> 'ASIA')) c
  ON w.district = c.district"""))
def q_encoder_policies(spark, sf_dir):
    """Codes of a panel without one district, applied to all: unseen is -1, or the first class."""
    from pyspark.sql import Window
    train = price_panel(spark, sf_dir).filter(F.col("district") != "ASIA")
    labels = train.select("district").distinct()
    labels = labels.select("district", (F.row_number().over(Window.orderBy("district")) - 1).cast("int").alias("code"))
    every = daily_signal(spark, sf_dir).select("district").distinct()
    coded = code_map(every, labels, "district")
    first = D.unseen_to_first(every.withColumn("w", F.col("district")), train, "district")
    return coded.join(first.select(F.col("w").alias("district"), F.col("district").alias("first_class")), "district")


@register("cluster_variation_check", "M17", sql="SELECT " + ", ".join(f"CAST(COUNT(DISTINCT {m}) AS BIGINT) AS {m}" for m in KM.PROFILE_MEASURES)
          + f" FROM ({QUERIES['district_profile'].sql}) t")
def q_cluster_variation_check(spark, sf_dir):
    p = district_profile(panel_with_weather(spark, sf_dir))
    return KM.variation_check(p.select(*[q4(m).alias(m) for m in KM.PROFILE_MEASURES]))


@register("seasonal_invariants", "M19 M21 P15", sql=with_views(["price_panel"], f"""
SELECT commodity, CAST(COUNT(*) AS BIGINT) AS history_days, CAST(30 AS BIGINT) AS forecast_days, MAX(date) + 30 AS last_date,
       {sq4('SUM(price)')} AS price_sum, true AS parts_add_up, true AS ordered
FROM (SELECT commodity, date, AVG(modal_price) AS price FROM price_panel WHERE modal_price > 0 GROUP BY 1, 2) GROUP BY 1"""))
def q_seasonal_invariants(spark, sf_dir):
    """What the seasonal forecast must keep: all days, 30 more, components that add up, ordered bounds."""
    f = SE.seasonal_forecast(price_panel(spark, sf_dir))
    whole = F.greatest(F.expm1(F.col("trend") + F.col("yearly") + F.col("weekly")), F.lit(0.0))
    return f.groupBy("commodity").agg(
        F.count_if(~F.col("is_forecast")).alias("history_days"), F.count_if("is_forecast").alias("forecast_days"), F.max("date").alias("last_date"),
        q4(F.sum("actual")).alias("price_sum"), F.bool_and(F.abs(whole - F.col("yhat")) <= 1e-6 * (1 + F.col("yhat"))).alias("parts_add_up"),
        F.bool_and((F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))).alias("ordered"))


@register("ml_forecast_shape", "M15 P20", sql=with_views(["price_panel"], """
SELECT commodity, district, CAST(30 AS BIGINT) AS days, MAX(date) + 1 AS first_date, MAX(date) + 30 AS last_date, true AS not_negative
FROM price_panel GROUP BY 1, 2"""))
def q_ml_forecast_shape(spark, sf_dir):
    """Thirty days after the last priced day for every key, none negative."""
    f = q_ml._model_forecast(spark, sf_dir)
    return f.groupBy("commodity", "district").agg(F.count(F.lit(1)).alias("days"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
                                                  F.bool_and(F.col("predicted_price") >= 0).alias("not_negative"))


@register("ml_model_invariants", "M12 L4 S10 M23", sql=with_views(["price_panel"], """
SELECT 'importances' AS what, CAST(20 AS BIGINT) AS n, true AS holds FROM (SELECT 1 FROM price_panel LIMIT 1)
UNION ALL SELECT 'top ten', CAST(10 AS BIGINT), true FROM (SELECT 1 FROM price_panel LIMIT 1)
UNION ALL SELECT 'reload', COUNT(DISTINCT (commodity, district)), true FROM price_panel"""))
def q_ml_model_invariants(spark, sf_dir):
    """Importances sum to one; a reloaded model predicts the same for every key."""
    imp = q_ml.q_ml_feature_importance(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), (F.abs(F.sum("importance") - 1) < 0.01).alias("holds"))
    same = q_ml.q_ml_model_persistence(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), (F.max("max_abs_diff") == 0).alias("holds"))
    least = q_ml.q_ml_feature_importance(spark, sf_dir).select(F.element_at(F.sort_array(F.collect_list("importance"), False), 10)).scalar()
    top = q_ml.q_ml_top_importances(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), (F.min("importance") >= least).alias("holds"))
    return imp.select(F.lit("importances").alias("what"), "n", "holds").unionByName(top.select(F.lit("top ten").alias("what"), "n", "holds")).unionByName(same.select(F.lit("reload").alias("what"), "n", "holds"))


# Rows of the model panel: 30 earlier prices of the key and a full weather record (see ml.data.model_panel).
_MODEL_ROWS = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY commodity, district ORDER BY date) AS rn FROM panel_wx) WHERE rn > 30"""
_MODEL_SPLIT = """SELECT date AS split_date FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i FROM (SELECT DISTINCT date FROM mp))
  WHERE i = (SELECT floor(COUNT(DISTINCT date) * 0.8) FROM mp)"""
_MODEL_CTES = [("mp", _MODEL_ROWS), ("msplit", _MODEL_SPLIT)]


@register("ml_run_invariants", "M4 M5 M11 M25 M2", sql=with_views(["panel_wx"], """
SELECT m.model, CAST(COUNT(*) FILTER (WHERE date < split_date) AS BIGINT) AS train_rows, CAST(COUNT(*) FILTER (WHERE date >= split_date) AS BIGINT) AS test_rows,
       true AS one_selected, true AS split_whole
FROM mp, msplit, (VALUES ('random_forest'), ('boosted_trees'), ('tuned_boosted_trees')) m(model) GROUP BY 1""", _MODEL_CTES))
def q_ml_run_invariants(spark, sf_dir):
    """The run log's rows; each rule selects one model; the random split keeps every row once."""
    log = q_ml.q_ml_run_log(spark, sf_dir).select("model", "train_rows", "test_rows")
    flags = ["selected", "selected_by_r2", "selected_by_mae"]
    one = q_ml.q_ml_model_comparison(spark, sf_dir).agg(*[F.sum(F.col(c).cast("int")).alias(c) for c in flags])
    one = one.select((F.least(*flags) == 1).alias("a"), (F.greatest(*flags) == 1).alias("b"))
    mp = D.model_panel(spark, sf_dir)
    a, b = D.random_split(mp)
    keys = ["commodity", "district", "date"]
    both = a.select(*keys).unionByName(b.select(*keys)).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(*keys).alias("d"))
    whole = both.join(mp.agg(F.count(F.lit(1)).alias("all")), F.col("n") == F.col("all")).select((F.col("n") == F.col("d")).alias("split_whole"))
    return (log.withColumns({"one_selected": one.select(F.col("a") & F.col("b")).scalar(), "split_whole": F.coalesce(whole.scalar(), F.lit(False))}))


@register("model_rescore_check", "M5 M4 M11 M12", sql=with_views(["panel_wx"], """
SELECT commodity, CAST(COUNT(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS mismatches, true AS metrics_agree
FROM mp, msplit WHERE date >= split_date GROUP BY 1""", _MODEL_CTES))
def q_model_rescore_check(spark, sf_dir):
    """The selected model's test predictions against its node table, walked by joins alone;
    its stored error metrics against those of the walked predictions."""
    model, _, test = q_ml._selected_model(spark, sf_dir)
    rows = model.encoded(test).select(*R.ROW, D.TARGET, F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("-inf"))) for c in model.features]).alias("x"))
    walked = R.node_walk(model, rows, R.ROW)
    told = R.predict(model, test).select(*R.ROW, D.TARGET, "prediction")
    both = told.join(walked, R.ROW, "left")
    own = F.greatest("walked", F.lit(0.0))
    mae = both.agg(F.avg(F.abs(F.col(D.TARGET) - own)).alias("mae")).scalar()
    stored = q_ml._comparison(spark, sf_dir).filter(F.col("model") == q_ml._selected(spark, sf_dir)).select("mae").scalar()
    off = F.coalesce(F.abs(F.col("prediction") - own) > 1e-6 * (1 + F.abs(own)), F.lit(True))
    return both.groupBy("commodity").agg(F.count(F.lit(1)).alias("rows"), F.count_if(off).alias("mismatches")).withColumn("metrics_agree", F.abs(mae - stored) < 1e-6 * (1 + stored))


@register("classifier_invariants", "M7 M10 M24 D16", sql=with_views(["panel_wx"], """
SELECT commodity, CASE WHEN modal_price <= p33 THEN 'Cheap' WHEN modal_price <= p66 THEN 'Normal' ELSE 'Expensive' END AS price_category,
       CAST(COUNT(*) AS BIGINT) AS test_rows, true AS probabilities_sum, true AS accuracy_agrees
FROM (SELECT m.*, b.p33, b.p66 FROM mp m JOIN (SELECT commodity, quantile_cont(modal_price, 0.33) AS p33, quantile_cont(modal_price, 0.66) AS p66 FROM mp GROUP BY 1) b USING (commodity)), msplit
WHERE date >= split_date GROUP BY 1, 2""", _MODEL_CTES))
def q_classifier_invariants(spark, sf_dir):
    """Test rows per actual class; probabilities sum to one; accuracy equals the confusion's diagonal."""
    p = q_ml._classifier(spark, sf_dir)
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x)
    own = p.agg(F.avg((F.col("price_category") == F.col("predicted_category")).cast("double")).alias("a"))
    told = q_ml.q_price_category_classifier(spark, sf_dir).filter("metric = 'accuracy'").select("value")
    g = p.groupBy("commodity", "price_category").agg(F.count(F.lit(1)).alias("test_rows"), F.bool_and(F.abs(total - 1) < 1e-9).alias("probabilities_sum"))
    return g.withColumn("accuracy_agrees", F.abs(own.scalar() - told.scalar()) < 1e-9)


@register("outlier_invariants", "M18 D15", sql=f"""
SELECT commodity, CAST(COUNT(*) AS BIGINT) AS rows, true AS share_kept, true AS labels_agree
FROM (SELECT *, row_number() OVER (PARTITION BY commodity, district ORDER BY date) AS rn FROM ({QUERIES['crisis_scores'].sql}) t) WHERE rn > 4 GROUP BY 1""")
def q_outlier_invariants(spark, sf_dir):
    """Every crisis row with full rolling features (from a key's fifth day) scored; at most 2 % flagged, by the sign of the decision; labels follow the flag."""
    o = q_ml._outliers(spark, sf_dir)
    out = F.col("outlier_flag") == -1
    ok = (out == (F.col("decision") < 0)) & (out == (F.col("event_type") == F.lit("Abnormal Event")))
    return o.groupBy("commodity").agg(F.count(F.lit(1)).alias("rows"), (F.count_if(out) <= F.ceil(F.count(F.lit(1)) * 0.02)).alias("share_kept"), F.bool_and(ok).alias("labels_agree"))


@register("cluster_invariants", "M16 D11 A25", sql=with_views(["price_panel"], """
SELECT CAST(COUNT(DISTINCT district) AS BIGINT) AS districts, true AS once, true AS summary_agrees FROM price_panel"""))
def q_cluster_invariants(spark, sf_dir):
    """Every district in one cluster; the summary counts them all."""
    c = q_ml.q_district_clusters(spark, sf_dir).agg(F.count(F.lit(1)).alias("districts"), F.count_distinct("district").alias("d"))
    s = q_ml.q_cluster_summary(spark, sf_dir).agg(F.sum("districts").alias("s"))
    return c.select("districts", (F.col("districts") == F.col("d")).alias("once"), (s.scalar() == F.col("districts")).alias("summary_agrees"))


@register("request_scoring_invariants", "M22 J13", sql=with_views(["price_panel", "daily_signal"], """
SELECT commodity, district, CAST(COUNT(*) AS BIGINT) AS requests, true AS answered FROM
  (SELECT DISTINCT commodity, district FROM price_panel) JOIN daily_signal USING (district) GROUP BY 1, 2"""))
def q_request_scoring_invariants(spark, sf_dir):
    """Each request has either an error or a price, scores of its key and 30 forecast days."""
    r = q_ml.q_batch_request_scoring(spark, sf_dir)
    ok = F.col("error").isNotNull() | (F.col("predicted_price").isNotNull() & F.col("farmer_intelligence_score").isNotNull() & (F.col("forecast_days") == 30))
    return r.groupBy("commodity", "district").agg(F.count(F.lit(1)).alias("requests"), F.bool_and(ok).alias("answered"))


@register("commodity_forecast_invariants", "M14 M6", sql=with_views(["price_panel"], """
SELECT commodity, CAST(30 AS BIGINT) AS days, MAX(date) + 1 AS first_date, true AS not_negative FROM price_panel GROUP BY 1"""))
def q_commodity_forecast_invariants(spark, sf_dir):
    """Thirty days after the commodity's last day; the per-commodity models cover every commodity."""
    f = q_ml.q_ml_commodity_forecast(spark, sf_dir)
    g = f.groupBy("commodity").agg(F.count(F.lit(1)).alias("days"), F.min("date").alias("first_date"), F.bool_and(F.col("predicted_price") >= 0).alias("not_negative"))
    return g.join(q_ml.q_ml_per_commodity_models(spark, sf_dir).select("commodity"), "commodity")


@register("seasonal_evaluation_invariants", "M20", sql=with_views(["price_panel"], """
SELECT commodity, CASE WHEN date < split_date THEN 'in_sample' ELSE 'out_of_sample' END AS sample, CAST(COUNT(*) AS BIGINT) AS rows, true AS errors_ordered
FROM (SELECT DISTINCT commodity, date FROM price_panel WHERE modal_price > 0), split GROUP BY 1, 2""", [("split", q_ml.SPLIT_SQL)]))
def q_seasonal_evaluation_invariants(spark, sf_dir):
    """Days before and after the cut; a mean error never exceeds the root mean square error."""
    e = q_ml.q_seasonal_evaluation(spark, sf_dir)
    return e.select("commodity", "sample", "rows", (F.col("mae") <= F.col("rmse") + 1e-6).alias("errors_ordered"))
