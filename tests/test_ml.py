import tempfile

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from paths import SF_SMALL
from pricelens.ml import data as D
from pricelens.ml import iforest as IF
from pricelens.ml import regress as R
from pricelens.ml.forecast import recursive_forecast
from pricelens.ml.metrics import regression_metrics
from pricelens.sources.adapter import price_panel

SMALL_GBT = R.TreeSpec(kind="boost", trees=5, depth=3, step=0.2)


def test_split_has_no_overlap_and_matches_rule(spark):
    mp = D.model_panel(spark, SF_SMALL)
    train, test = D.chrono_split(mp, "date_fraction")
    D.assert_no_overlap(train, test)
    dates = sorted(r.date for r in mp.select("date").distinct().collect())
    assert test.agg(F.min("date")).first()[0] == dates[int(len(dates) * 0.8)]
    assert train.count() + test.count() == mp.count()


def test_metrics_equal_evaluator(spark):
    mp = D.model_panel(spark, SF_SMALL)
    train, test = D.chrono_split(mp, "date_fraction")
    pred = R.predict(R.fit(train, SMALL_GBT), test, clamp=False)
    m = regression_metrics(pred).first()
    ev = RegressionEvaluator(labelCol="modal_price", predictionCol="prediction")
    assert abs(m.mae - ev.setMetricName("mae").evaluate(pred)) < 1e-6
    assert abs(m.rmse - ev.setMetricName("rmse").evaluate(pred)) < 1e-6
    assert abs(m.r2 - ev.setMetricName("r2").evaluate(pred)) < 1e-6


def test_model_persistence_roundtrip(spark):
    mp = D.model_panel(spark, SF_SMALL)
    model = R.fit(mp, SMALL_GBT)
    path = tempfile.mkdtemp(prefix="pricelens-model-")
    R.save_model(model, path, {"features": R.FEATURE_COLUMNS, "target": D.TARGET})
    m2, meta = R.load_model(spark, path)
    assert meta["target"] == "modal_price"
    a = model.transform(mp).select(*R.ROW, "prediction").orderBy(*R.ROW).toPandas()
    b = m2.transform(mp).select(*R.ROW, "prediction").orderBy(*R.ROW).toPandas()
    assert (a == b).all().all()


def test_recursive_forecast_invariants(spark):
    mp = D.model_panel(spark, SF_SMALL)
    model = R.fit(mp, SMALL_GBT)
    fc = recursive_forecast(model, mp, horizon=12).toPandas()
    per_key = fc.groupby(["commodity", "district"]).size()
    assert (per_key == 12).all()
    assert (fc.predicted_raw >= 0).all()
    assert ((fc.predicted_price - fc.predicted_raw).abs() <= 0.005 + 1e-9).all()
    assert fc.groupby(["commodity", "district"])["date"].nunique().eq(12).all()


def test_forecast_equals_steps_taken_one_by_one(spark):
    """All steps in one task, and a job for each step over the scored table, give the same values."""
    from pricelens.ml.forecast import initial_state, step_features
    mp = D.model_panel(spark, SF_SMALL)
    model = R.fit(mp, SMALL_GBT)
    got = {(r.commodity, r.district, r.date): (r.predicted_raw, r.predicted_price) for r in recursive_forecast(model, mp, horizon=6).collect()}
    state, want = initial_state(mp), {}
    for _ in range(6):
        p = F.greatest("prediction", F.lit(0.0))
        state = model.transform(step_features(state)).withColumn("hist", F.slice(F.concat("hist", F.array(p)), -30, 30)).withColumn("rounded", F.bround(p, 2))
        state = spark.createDataFrame(state.select(*mp.columns, "hist", "rounded").collect(), state.select(*mp.columns, "hist", "rounded").schema)
        want |= {(r.commodity, r.district, r.date): (r.hist[-1], r.rounded) for r in state.collect()}
        state = state.drop("rounded")
    assert got == want and len(got) == 6 * mp.select("commodity", "district").distinct().count()


def test_forecast_of_a_model_too_large_for_a_task(spark, monkeypatch):
    """A job a day gives what one task gives, value by value, with missing prices and a key without a model too."""
    from pricelens.ml import forecast as FC
    rows = [(k, day, None if k == "b" and day == 58 else 100.0 + 10 * (day % 7) + day / 9 + len(k)) for k in ("a", "b", "new") for day in range(60)]
    df = spark.createDataFrame(rows, "commodity string, n int, modal_price double").selectExpr("commodity", "date_add(DATE '2024-01-01', n) AS date", "modal_price")
    lags = (1, 2, 3)
    from pricelens.ml.grouped_trees import fit_trees
    features = [f"lag_{k}" for k in lags] + ["rolling_7", "rolling_30", "month", "day", "day_of_week"]
    rich = df.selectExpr("*", *(f"lag(modal_price, {k}) OVER (PARTITION BY commodity ORDER BY date) AS lag_{k}" for k in lags), *(f"avg(modal_price) OVER (PARTITION BY commodity ORDER BY date ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS rolling_{k}" for k in (7, 30)), "month(date) AS month", "day(date) AS day", "weekday(date) AS day_of_week")
    model = fit_trees(rich.filter("commodity <> 'new'"), features, "modal_price", ["commodity", "date"], R.TreeSpec(trees=7, depth=6), key="commodity")

    def forecast():
        return sorted(map(tuple, recursive_forecast(model, df, horizon=4, keys=("commodity",), lags=lags).collect()))
    want = forecast()
    monkeypatch.setattr(FC, "MODEL_BYTES", 1)
    assert forecast() == want and len(want) == 8


def test_isolation_forest_contamination_share(spark):
    p = price_panel(spark, SF_SMALL)
    o = IF.isolation_forest(p, "commodity", ["modal_price", "arrival"], ["commodity", "district", "date"],
                            trees=25, psi=64).toPandas()
    share = (o.outlier_flag == -1).groupby(o.commodity).mean()
    counts = o.groupby("commodity").size()
    for c, s in share.items():
        assert abs(s * counts[c] - 0.02 * counts[c]) <= 1.0 + 1e-9
    assert o.anomaly_score.between(0, 1).all()


def test_isolation_forest_isolates_extreme_point(spark):
    rows = [("g", float(i % 10), float(i % 7), i) for i in range(300)] + [("g", 500.0, 500.0, 999)]
    df = spark.createDataFrame(rows, "grp0 string, a double, b double, id int")
    o = IF.isolation_forest(df, "grp0", ["a", "b"], ["id"], trees=50, psi=128).toPandas()
    top = o.sort_values("anomaly_score", ascending=False).iloc[0]
    assert top.id == 999 and top.outlier_flag == -1


def test_isolation_forest_decisions_by_brute_force(spark):
    """Scores walked node by node over the same trees; the threshold as pandas has it; a forest's copies stay below the data."""
    import numpy as np
    rng = np.random.default_rng(4)
    rows = [("g", float(a), float(b), i) for i, (a, b) in enumerate(rng.normal(size=(700, 2)))] + [("h", 1.0, float(i), 1000 + i) for i in range(40)]
    df = spark.createDataFrame(rows, "grp0 string, a double, b double, id int")
    nodes = {}

    def walk(x, grp, trees):
        total = 0.0
        for t in range(trees):
            own, at, depth = nodes[grp, t], 0, 0
            while own["feature"][at] >= 0:
                at = own["left"][at] if x[own["feature"][at]] < own["threshold"][at] else own["right"][at]
                depth += 1
            total += depth + float(IF.c_factor(own["size"][at]))
        return total / trees
    out = IF.isolation_forest(df, "grp0", ["a", "b"], ["id"], trees=20, psi=32)
    packed = IF.forest(df, "grp0", ["a", "b"], ["id"], trees=20, psi=32)
    for r in packed.collect():
        nodes[r.grp, r.tree] = {c: np.frombuffer(r[c], d) for c, d in IF._PARTS}
    got = out.toPandas()
    for r in got.itertuples():
        assert abs(r.anomaly_score - 2 ** (-walk((r.a, r.b), r.grp0, 20) / float(IF.c_factor(32)))) < 1e-12
    for g, own in got.groupby("grp0"):
        thr = own.anomaly_score.quantile(0.98)
        assert np.allclose(own.decision, thr - own.anomaly_score) and ((own.outlier_flag == -1) == (own.decision < 0)).all(), g
    rows_ = IF.chunk_rows(200, 256, 5)
    assert rows_ * 5 * IF.VALUE_BYTES >= IF.SHARE * 200 * 2 * 256 * IF.NODE_BYTES - 40


def test_seasonal_forecast_invariants(spark):
    from pricelens.ml import seasonal as SE
    p = price_panel(spark, SF_SMALL)
    fc = SE.seasonal_forecast(p, horizon=30).toPandas()
    fut = fc[fc.is_forecast]
    assert (fut.groupby("commodity").size() == 30).all()
    assert (fc.yhat >= 0).all() and (fc.yhat_lower <= fc.yhat + 1e-9).all() and (fc.yhat <= fc.yhat_upper + 1e-9).all()
    hist = fc[~fc.is_forecast]
    assert hist.actual.notna().all() and fut.actual.isna().all()
    # components add up to the fitted log-price
    import numpy as np
    assert np.allclose(np.expm1(fc.trend + fc.yearly + fc.weekly).clip(lower=0), fc.yhat, rtol=1e-6, atol=1e-6)


def test_district_clusters_and_summary(spark):
    from pricelens.ml import cluster as KM
    from pricelens.operators.panel import panel_with_weather
    from pricelens.plans.q_aggregates import district_profile
    prof = district_profile(panel_with_weather(spark, SF_SMALL))
    ks = KM.k_search(prof, ks=range(2, 4)).toPandas()
    assert list(ks.k) == [2, 3] and (ks.inertia >= 0).all()
    cl = KM.cluster_districts(prof, KM.WEATHER_MEASURES, k=2)
    pdf = cl.select("district", "cluster").toPandas()
    assert len(pdf) == prof.count() and set(pdf.cluster) <= {0, 1}
    summ = KM.cluster_summary(cl).toPandas()
    assert summ.districts.sum() == len(pdf)
    assert KM.variation_check(prof).first()["average_price"] == len(pdf)


def test_classifier_metrics_and_confusion(spark):
    from pyspark.sql import functions as F

    from pricelens.ml import classify as CL
    from pricelens.ml.metrics import classification_report, confusion_matrix
    mp = CL.price_category(D.model_panel(spark, SF_SMALL))
    train, test = D.chrono_split(mp, "date_fraction")
    pred = CL.classified(CL.fit_classifiers(train, CL.TreeSpec(trees=5, depth=4)), test).cache()
    m = CL.classification_metrics(pred)
    acc = pred.select(F.avg((F.col("price_category") == F.col("predicted_category")).cast("double"))).first()[0]
    assert abs(m["accuracy"] - acc) < 1e-9 and 0 <= m["weighted_auc_ovr"] <= 1
    cm = confusion_matrix(pred, "price_category", "predicted_category", CL.CLASSES).toPandas()
    assert int(cm[CL.CLASSES].to_numpy().sum()) == test.count()
    rep = classification_report(pred, "price_category", "predicted_category").toPandas()
    assert int(rep.support.sum()) == test.count()
    probs = pred.select("probabilities").toPandas().probabilities
    assert all(abs(sum(p) - 1.0) < 1e-6 for p in probs)


def test_elastic_net_equals_spark(spark):
    """Coordinate descent on the summed Gram matrix, and Spark's elastic net over the rows of one commodity."""
    import numpy as np
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import LinearRegression

    from pricelens.ml import seasonal as SE
    own = price_panel(spark, SF_SMALL).filter("commodity = 'PROMO' AND modal_price > 0").groupBy("date").agg(F.avg("modal_price").alias("p")).orderBy("date").toPandas()
    import pandas as pd
    d = pd.to_datetime(own.date)
    t = ((d - d.min()).dt.days / max((d.max() - d.min()).days, 1)).to_numpy()
    x, _, _ = SE._design(t, d.dt.dayofweek.to_numpy(float), d.dt.dayofyear.to_numpy(float), np.linspace(0, 0.8, 7)[1:-1], yearly_order=2, weekly_order=1)
    y, n = np.log1p(own.p.to_numpy()), len(own)
    reg, alpha = 0.01, 0.5
    l1, l2 = np.full(x.shape[1], reg * alpha * n), np.full(x.shape[1], reg * (1 - alpha) * n)
    # Spark divides the target by its deviation: raw, its L1 term is the same and its L2 term is divided by the deviation
    l2 /= y.std(ddof=1)
    l1[0] = l2[0] = 0.0
    b = SE.elastic_net(x.T @ x, x.T @ y, l1, l2)
    rows = spark.createDataFrame([(float(v), Vectors.dense(r[1:])) for v, r in zip(y, x, strict=True)], ["label", "features"])
    m = LinearRegression(regParam=reg, elasticNetParam=alpha, standardization=False, maxIter=5000, tol=1e-12, solver="l-bfgs").fit(rows)
    assert np.allclose(b[1:], m.coefficients.toArray(), atol=1e-5) and abs(b[0] - m.intercept) < 1e-4
    assert (b[1:] == 0).any() and (b[1:] != 0).any()
    strong = SE.elastic_net(x.T @ x, x.T @ y, np.where(np.arange(x.shape[1]) > 1, 1e9, 0.0), np.zeros(x.shape[1]))
    assert (strong[2:] == 0).all()


def test_euclidean_silhouette_picks_the_k(spark):
    """Equal to the definition over all pairs, whatever the blocks; a fixture where the squared form prefers another K."""
    import numpy as np

    from pricelens.ml import cluster as KM

    def plain(x, c, power=1):
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) ** power
        out = []
        for i in range(len(x)):
            same = c == c[i]
            a = d[i][same].sum() / max(same.sum() - 1, 1)
            b = min(d[i][c == k].mean() for k in set(c) if k != c[i])
            out.append(0.0 if same.sum() == 1 else (b - a) / max(a, b))
        return float(np.mean(out))
    rng = np.random.default_rng(2)
    for _ in range(200):
        x = np.concatenate([rng.normal(m, s, (int(rng.integers(2, 6)), 2)) for m, s in zip(rng.uniform(-4, 4, 4), rng.uniform(0.1, 2, 4), strict=True)])
        labels = {k: rng.integers(0, k, len(x)) if k > 3 else (x[:, 0] > np.quantile(x[:, 0], 0.5)).astype(int) + (k == 3) * (x[:, 1] > np.quantile(x[:, 1], 0.7)) for k in (2, 3)}
        if all(len(set(c)) > 1 for c in labels.values()):
            flat, squared = ({k: plain(x, c, p) for k, c in labels.items()} for p in (1, 2))
            if max(flat, key=flat.get) != max(squared, key=squared.get):
                break
    else:
        raise AssertionError("no fixture found")
    rows = spark.createDataFrame([(str(i), [float(v) for v in p], [int(labels[2][i]), int(labels[3][i])]) for i, p in enumerate(x)], "id string, x array<double>, clusters array<int>")
    for block in (1000, 4):
        got = {r.k: r.silhouette for r in KM.silhouettes(rows, [2, 3], block).collect()}
        assert all(abs(got[k] - flat[k]) < 1e-9 for k in (2, 3))
        assert max(got, key=got.get) == max(flat, key=flat.get) != max(squared, key=squared.get)
