"""Many keys: nothing is capped by a number of districts, commodities or categories."""

import datetime as dt
import math
import random

import pandas as pd

from pricelens.ml import iforest as IF
from pricelens.ml import regress as R
from pricelens.ml.data import CATEGORICAL, NUMERIC, TARGET
from pricelens.operators import aggregates as AG
from pricelens.operators import stats as S


def test_correlations_of_150_series(spark):
    rng = random.Random(4)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(12)]
    rows = [("c", f"d{k:03d}", d, 5.0 if k == 7 else rng.random() * 10 + k) for k in range(150) for d in days if rng.random() > 0.2]
    df = spark.createDataFrame(rows, "commodity string, district string, date date, modal_price double")
    got = {(r.series_a, r.series_b): r["corr"] for r in AG.pair_correlations(df, ["commodity"], "date", "district", "modal_price").collect()}
    wide = pd.DataFrame(rows, columns=["c", "d", "t", "v"]).pivot(index="t", columns="d", values="v")
    want = wide.corr(min_periods=2)
    assert len(got) == 150 * 149
    for (a, b), v in got.items():
        w = want.loc[a, b]
        assert (v is None and (w != w or 7 in (int(a[1:]), int(b[1:])))) or math.isclose(v, w, abs_tol=1e-9)


def test_trees_take_any_number_of_categories(spark):
    rng = random.Random(5)
    rows = [tuple(f"{c}{k % 90}" for c in CATEGORICAL) + tuple(rng.random() for _ in NUMERIC) + (float(k % 90),) for k in range(400)]
    df = spark.createDataFrame(rows, ", ".join([*(f"{c} string" for c in CATEGORICAL), *(f"{c} double" for c in NUMERIC), f"{TARGET} double"]))
    model = R.fit(df, R.TreeSpec(trees=2, depth=3))
    assert R.predict(model, df).count() == 400


def test_forest_over_300_groups(spark):
    rows = [(f"g{k % 300}", float(k % 17), float(k % 13), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, a double, b double, id int")
    o = IF.isolation_forest(df, "g", ["a", "b"], ["id"], trees=3, psi=16)
    assert o.count() == 3000 and o.select("g").distinct().count() == 300


def test_attach_reads_a_one_row_aggregate_once(spark):
    base = spark.range(100).selectExpr("id", "id % 7 AS k", "id * 1.5 AS x")
    path = "attach_one_row"
    base.createOrReplaceTempView(path)
    small = spark.table(path).agg({"x": "max", "id": "min", "k": "avg"}).toDF("a", "b", "c")
    j = S.attach(spark.table(path), small)
    assert j.count() == 100
    j.collect()
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Subquery scalar-subquery") <= 1 + plan.count("ReusedSubquery")
