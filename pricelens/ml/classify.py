"""Price-category classifiers.

Category per commodity from its 33 % / 66 % price percentiles (inclusive
upper bounds): Cheap <= p33 < Normal <= p66 < Expensive.  A random forest for
every commodity, with its classes weighted to count alike (rows / (classes *
rows of the class)), predicts it; the class shares stand in an array column.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.ml.data import indexers
from pricelens.ml.grouped_trees import TreeModel, TreeSpec, fit_trees
from pricelens.operators.stats import broadcast_if_small, quantile_columns

CLASSES = ["Cheap", "Normal", "Expensive"]
CLASSIFIER_FEATURES = ["district_code", "festival_code", "arrival", "max_temp", "min_temp",
                       "rainfall_mm", "wind", "holiday", "month", "year", "day", "weekend_int", "day_of_week",
                       "quarter"]
#: The classifier's settings.
CLASSIFIER = TreeSpec(trees=300, depth=15, min_leaf=2, min_split=5, features="sqrt")


def price_category(df: DataFrame, keys=("commodity",), value: str = "modal_price") -> DataFrame:
    """Per-key percentile bounds (one aggregate, broadcast back)."""
    keys = list(keys)
    b = quantile_columns(df, value, {"p33": 0.33, "p66": 0.66}, keys)
    j = df.join(broadcast_if_small(b), keys)
    v = F.col(value)
    return j.withColumn("price_category", F.when(v <= F.col("p33"), "Cheap")
                        .when(v <= F.col("p66"), "Normal").otherwise("Expensive"))


def balanced_weights(df: DataFrame, label: str = "price_category", keys=()) -> DataFrame:
    """weight = n / (k * n_class) within each key group.

    Counts come from grouped aggregates (map-side combined) joined back, not
    from unbounded windows, so a hot group is never buffered in one task.
    """
    from pricelens.operators.stats import attach
    keys = list(keys)
    per_class = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_nc"))
    per_key = per_class.groupBy(*keys).agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    j = attach(df, per_class, keys + [label])
    j = attach(j, per_key, keys) if keys else attach(j, per_key)
    return j.withColumn("weight", F.col("_n") / (F.col("_k") * F.col("_nc"))).drop("_nc", "_n", "_k")


def fit_classifiers(train: DataFrame, spec: TreeSpec = CLASSIFIER, key: str | None = "commodity") -> TreeModel:
    """One balanced forest per commodity, all grown in the same jobs."""
    encoder = Pipeline(stages=indexers(["district", "festival"], "keep")).fit(train)
    return fit_trees(encoder.transform(train), CLASSIFIER_FEATURES, "price_category", ["commodity", "district", "date"], spec, key=key, labels=CLASSES, encoder=encoder)


def classified(model: TreeModel, rows: DataFrame) -> DataFrame:
    """Predicted class, class shares (in the order of CLASSES) and their numeric forms for the evaluators;
    rows whose commodity has no classifier are left out."""
    def code(c):
        return (F.array_position(F.array(*map(F.lit, CLASSES)), F.col(c)) - 1).cast("double")
    out = model.transform(rows).filter(F.col("predicted_category").isNotNull())
    return out.withColumns({"label": code("price_category"), "prediction": code("predicted_category"), "probability": array_to_vector("probabilities")})


def classification_metrics(pred: DataFrame) -> dict:
    """Accuracy, weighted precision/recall/F1, weighted one-vs-rest AUC."""
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    out = {m: ev.setMetricName(m).evaluate(pred)
           for m in ("accuracy", "weightedPrecision", "weightedRecall", "f1")}
    probs = pred.withColumn("_p", vector_to_array("probability"))
    support = {r.label: r["count"] for r in probs.groupBy("label").count().collect()}
    total, auc = sum(support.values()), 0.0
    for lab, n in support.items():
        b = probs.select(F.col("_p")[int(lab)].alias("rawPrediction"),
                         (F.col("label") == lab).cast("double").alias("y"))
        a = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol="y").evaluate(b)
        auc += a * n / total
    out["weighted_auc_ovr"] = auc
    return out
