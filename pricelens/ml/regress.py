"""Price regressors.

Forests and boosted trees (:mod:`pricelens.ml.grouped_trees`) on the
chronological split, at the reference learners' settings: their estimators are
``trees``, min_child_weight ``min_leaf``, learning_rate ``step``, colsample
``features``, gamma ``min_gain``, alpha and lambda ``l1`` and ``l2``.  Features
are cut into 64 quantile bins; a forest's depth is bounded by 30.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.ml.data import CATEGORICAL, NUMERIC, TARGET, indexers
from pricelens.ml.grouped_trees import TreeModel, TreeSpec, fit_trees
from pricelens.ml.metrics import regression_metrics

FEATURE_COLUMNS = [f"{c}_code" for c in CATEGORICAL] + NUMERIC
#: What names a row of the panel.
ROW = ["commodity", "district", "date"]

# The compared models' settings.
MODEL_SPECS = {
    "random_forest": TreeSpec(trees=300, depth=30, min_leaf=2),
    "boosted_trees": TreeSpec(kind="boost", trees=500, depth=8, step=0.03, min_leaf=3, subsample=0.85, features=0.85, l1=0.05, l2=1.0),
    "tuned_boosted_trees": TreeSpec(kind="boost", trees=800, depth=6, step=0.025, min_leaf=5, subsample=0.9, features=0.9, min_gain=0.05, l1=0.1, l2=2.0),
}


def fit(train: DataFrame, spec: TreeSpec, key: str | None = None) -> TreeModel:
    """Fit one model, or with ``key`` one for each of its values, all in the same jobs (M6)."""
    encoder = Pipeline(stages=indexers(handle_invalid="keep")).fit(train)
    return fit_trees(encoder.transform(train), FEATURE_COLUMNS, TARGET, [c for c in ROW if c in train.columns], spec, key=key, encoder=encoder)


def predict(model: TreeModel, df: DataFrame, clamp: bool = True) -> DataFrame:
    """Predictions with residuals; prices clamped at 0 (P20)."""
    out = model.transform(df)
    if clamp:
        out = out.withColumn("prediction", F.greatest(F.col("prediction"), F.lit(0.0)))
    return out.withColumn("error", F.col(TARGET) - F.col("prediction"))


#: The order of each selection rule, best first; a minus is descending.
SELECTION_RULES = {
    "mae_rmse_r2": ["mae", "rmse", "-r2"],
    "higher_r2": ["-r2", "model"],
    "lower_mae": ["mae", "model"],
}


def select_model(metrics: DataFrame, rule: str = "mae_rmse_r2") -> str:
    """Name of the best model under a rule."""
    return metrics.orderBy(*[F.desc(c[1:]) if c[0] == "-" else F.asc(c) for c in SELECTION_RULES[rule]]).first().model


def compare_models(train: DataFrame, test: DataFrame, specs: dict, fit_one=None) -> tuple[DataFrame, dict]:
    """Metrics of every model on the test split; selection = lowest MAE,
    then RMSE, then highest R2 (the final selection rule).  ``fit_one(name)``
    gives a fitted model, by default fitted here."""
    from concurrent.futures import ThreadPoolExecutor
    spark = train.sparkSession
    rows = []
    # a boosted model takes one task for most of its fit, so the fits run beside each other
    with ThreadPoolExecutor(len(specs)) as pool:
        models = dict(zip(specs, pool.map(lambda name: fit_one(name) if fit_one else fit(train, specs[name]), specs), strict=True))
    for name, m in models.items():
        met = regression_metrics(predict(m, test)).first()
        rows.append((name, float(met.mae), float(met.rmse), None if met.r2 is None else float(met.r2), int(met.rows)))
    df = spark.createDataFrame(rows, "model string, mae double, rmse double, r2 double, test_rows long")
    return df.orderBy("mae", "rmse", F.desc("r2")), models


def feature_importance(model: TreeModel) -> DataFrame:
    """Importance per input column, descending."""
    return model.importance()


def save_model(model: TreeModel, path: str, meta: dict) -> None:
    """Node tables, encoder and metadata (features, target, model name)."""
    model.save(path, meta)


def load_model(spark: SparkSession, path: str) -> tuple[TreeModel, dict]:
    return TreeModel.load(spark, path), TreeModel.meta(spark, path)


def per_key_models(train: DataFrame, test: DataFrame, key: str, spec: TreeSpec) -> DataFrame:
    """M6: test predictions of one model per value of ``key``; a value without a model is left out."""
    return predict(fit(train, spec, key), test).filter(F.col("error").isNotNull())


def node_walk(model: TreeModel, rows: DataFrame, ids: list[str], key: str | None = None) -> DataFrame:
    """``ids`` and ``walked``: predictions by joins of rows (with the features' array ``x``) and the node table.

    A level is a join on (key, tree, node) of the rows still under way; rows that
    reach a leaf are set aside.  The same numbers as ``transform`` by another way.
    """
    nodes = model.nodes.select("key", "tree", "node", "feature", "threshold", F.get("value", F.lit(0)).alias("value"))
    own = F.col(key).cast("string") if key else F.lit("")
    trees = F.explode(F.sequence(F.lit(-1 if model.spec.kind == "boost" else 0), F.lit(model.spec.trees - 1))).alias("tree")
    starts = rows.select(*ids, own.alias("key"), "x", trees, F.lit(1).cast("long").alias("node"))
    at = starts.join(nodes, ["key", "tree", "node"]).withColumnRenamed("key", "_key")
    columns = [*ids, "_key", "x", "tree", "node", "feature", "threshold", "value"]
    done = []
    for _ in range(model.spec.depth + 1):
        done.append(at.filter("feature < 0").select(*ids, "tree", "value"))
        to = F.col("node") * 2 + (F.get("x", F.col("feature")) > F.col("threshold")).cast("long")
        went = at.filter("feature >= 0").select(*ids, F.col("_key").alias("key"), "x", "tree", to.alias("node"))
        at = went.join(nodes, ["key", "tree", "node"]).withColumnRenamed("key", "_key").select(*columns)
    leaves = done[0]
    for d in done[1:]:
        leaves = leaves.unionByName(d)
    total = F.sum("value") if model.spec.kind == "boost" else F.avg("value")
    return leaves.groupBy(*ids).agg(total.alias("walked"))
