"""Hot-key fixtures: one key holds a third or more of the rows.

The time-blocked window and as-of paths must give exactly the plain results,
and the grouped-count class weights must not depend on the partitioning.
"""

import datetime as dt

import numpy as np
import pandas as pd

from pricelens.ml.classify import balanced_weights
from pricelens.operators import windows as W
from pricelens.operators.asof import asof_features


def _skewed(spark):
    rng = np.random.RandomState(11)
    base = dt.date(2020, 1, 1)
    rows = [("hot", "d", base + dt.timedelta(i), float(rng.uniform(5, 9))) for i in range(600)]
    for k in ("a", "b", "c"):
        rows += [(k, "d", base + dt.timedelta(int(i)), float(rng.uniform(5, 9)))
                 for i in sorted(rng.choice(600, 100, replace=False))]
    return spark.createDataFrame(rows, "commodity string, district string, date date, modal_price double")


def test_hot_key_blocked_windows_equal_plain(spark):
    df = _skewed(spark)
    plain = W.add_history_features(df).orderBy("commodity", "date").toPandas()
    blocked = W.blocked_history_features(df, block_days=30).orderBy("commodity", "date").toPandas()[plain.columns]
    pd.testing.assert_frame_equal(plain, blocked)


def test_hot_key_blocked_asof_equal_plain(spark):
    df = _skewed(spark)
    base = dt.date(2020, 1, 1)
    req = spark.createDataFrame([(k, "d", base + dt.timedelta(i)) for k in ("hot", "a", "zz") for i in range(0, 640, 3)],
                                "commodity string, district string, date date")
    a = asof_features(req, df).orderBy("commodity", "date").toPandas()
    b = asof_features(req, df, block_days=20).orderBy("commodity", "date").toPandas()
    pd.testing.assert_frame_equal(a, b)


def test_weights_independent_of_partitioning(spark):
    from pyspark.sql import functions as F
    df = _skewed(spark).withColumn("price_category", F.when(F.col("modal_price") < 7, "Cheap").otherwise("Normal"))
    a = balanced_weights(df, keys=["commodity"]).orderBy("commodity", "date").toPandas()
    b = balanced_weights(df.repartition(13), keys=["commodity"]).orderBy("commodity", "date").toPandas()
    pd.testing.assert_frame_equal(a, b)
    hot = a[a.commodity == "hot"]
    assert abs((hot.weight * 1).groupby(hot.price_category).sum().iloc[0] - len(hot) / 2) < 1e-6
