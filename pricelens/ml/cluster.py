"""District clustering.

Profile per district (A4) -> VectorAssembler -> StandardScaler(withMean,
withStd) -> KMeans(seed 42) for K = 2..6; K with the best silhouette is
refitted.  Spark's StandardScaler divides by the sample std (sklearn: the
population std), a common factor that leaves the labels unchanged (X17).
The silhouette is the plain Euclidean one: per district and cluster the sums of
distances are collected block by block, so a task holds two blocks of profiles
and any number of districts spreads over more tasks (X18).
"""

from __future__ import annotations

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pricelens.operators.stats import broadcast_if_small

PROFILE_MEASURES = ["average_price", "price_volatility", "average_arrival", "average_max_temp",
                    "average_min_temp", "average_rainfall", "average_wind"]
WEATHER_MEASURES = ["average_max_temp", "average_min_temp", "average_rainfall", "average_wind"]


def variation_check(profile: DataFrame, measures=PROFILE_MEASURES) -> DataFrame:
    """Distinct values per measure (1 = no variation to cluster on)."""
    return profile.agg(*[F.count_distinct(m).alias(m) for m in measures])


def _pipe(measures, k):
    return Pipeline(stages=[
        VectorAssembler(inputCols=measures, outputCol="_raw", handleInvalid="skip"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        KMeans(k=k, seed=42, featuresCol="features", predictionCol="cluster", maxIter=50)])


#: Profiles whose distances to as many others a task holds.
BLOCK = 1_000


def silhouettes(rows: DataFrame, ks: list[int], block: int = BLOCK) -> DataFrame:
    """(k, silhouette): mean Euclidean silhouette of several clusterings of the same points.

    ``rows`` hold ``id``, ``x`` (array) and ``clusters`` (one label per k).  A point
    alone in its cluster counts 0; a clustering of one cluster has none (null).
    """
    import numpy as np

    from pricelens.session import ship_package
    ship_package(rows.sparkSession)
    blocks = max(1, -(-rows.count() // block))
    own = rows.withColumn("_own", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    left = own.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    right = own.select(F.col("_own").alias("_other"), F.col("x").alias("y"), F.col("clusters").alias("to"))
    right = right.withColumn("_own", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def sums(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame([], columns=["id", "k", "mine", "cluster", "s", "n"])
        x, y = np.array(a["x"].tolist()), np.array(b["y"].tolist())
        d = np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(2))
        mine, to, out = np.array(a["clusters"].tolist()), np.array(b["to"].tolist()), []
        for i, k in enumerate(ks):
            for c in np.unique(to[:, i]):
                at = to[:, i] == c
                out.append(pd.DataFrame({"id": a["id"], "k": k, "mine": mine[:, i], "cluster": c, "s": d[:, at].sum(1), "n": int(at.sum())}))
        return pd.concat(out)

    parts = left.groupBy("_own", "_other").cogroup(right.groupBy("_own", "_other")).applyInPandas(sums, "id string, k int, mine int, cluster int, s double, n long")
    each = parts.groupBy("id", "k", "mine", "cluster").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    same = F.col("mine") == F.col("cluster")
    point = each.groupBy("id", "k").agg(F.max(F.when(same, F.col("n"))).alias("n"), F.max(F.when(same, F.try_divide("s", F.col("n") - 1))).alias("a"), F.min(F.when(~same, F.col("s") / F.col("n"))).alias("b"))
    value = F.when(F.col("n") == 1, 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return point.groupBy("k").agg(F.avg(F.when(F.col("b").isNotNull(), value)).alias("silhouette"))


def k_search(profile: DataFrame, measures=PROFILE_MEASURES, ks=range(2, 7)) -> DataFrame:
    """Inertia and Euclidean silhouette per K (driver loop over a handful of K values)."""
    profile = profile.cache()  # one row per district: reused by every K
    try:
        n = profile.count()
        ks = [k for k in ks if k < n]
        if not ks:
            return profile.sparkSession.createDataFrame([], "k int, inertia double, silhouette double")
        models = [_pipe(measures, k).fit(profile) for k in ks]
        points = None
        for k, m in zip(ks, models, strict=True):
            labelled = m.transform(profile).select(F.col("district").alias("id"), vector_to_array("features").alias("x"), F.col("cluster").alias(f"c{k}"))
            points = labelled if points is None else points.join(labelled.drop("x"), "id")
        rows = points.select("id", "x", F.array(*[f"c{k}" for k in ks]).alias("clusters"))
        found = {r.k: r.silhouette for r in silhouettes(rows, ks).collect()}  # a row per K
    finally:
        profile.unpersist()
    rows = [(k, float(m.stages[-1].summary.trainingCost), found.get(k)) for k, m in zip(ks, models, strict=True)]
    return profile.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def cluster_districts(profile: DataFrame, measures=PROFILE_MEASURES, k: int | None = None) -> DataFrame:
    """District profile + ``cluster``; K by best silhouette when not given."""
    if k is None:
        ks = k_search(profile, measures).orderBy(F.desc_nulls_last("silhouette"), "k").first()
        k = ks.k if ks is not None else 2
    m = _pipe(measures, k).fit(profile)
    return m.transform(profile).drop("_raw", "features")


def cluster_summary(clusters: DataFrame, district_intel: DataFrame | None = None) -> DataFrame:
    """Districts and mean measures per cluster (+ mean district risk)."""
    df = clusters
    aggs = [F.count(F.lit(1)).alias("districts"),
            F.array_join(F.array_sort(F.collect_list("district")), ", ").alias("district_list")]
    aggs += [F.avg(m).alias(m) for m in PROFILE_MEASURES if m in df.columns]
    if district_intel is not None:
        df = df.join(broadcast_if_small(district_intel.select("district", "district_risk_score", "average_crisis_score")),
                     "district", "left")
        aggs += [F.avg("district_risk_score").alias("avg_district_risk_score"),
                 F.avg("average_crisis_score").alias("avg_crisis_score")]
    return df.groupBy("cluster").agg(*aggs)
