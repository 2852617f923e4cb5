import datetime as dt
import math

from pyspark.sql import functions as F

from pricelens.functions import clip, isclose, pct_change, q4, safe_corr, safe_div, season, weekday0


def test_safe_div_and_pct_change_null_on_zero(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (None, 2.0)], "a double, b double")
    out = df.select(safe_div("a", "b").alias("d"), pct_change("a", "b").alias("p")).collect()
    assert out[0].d is None and out[0].p is None
    assert out[1].d == 2.5 and out[1].p == 150.0
    assert out[2].d is None


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")  # Mon, Sun
    assert [r.w for r in df.select(weekday0("d").alias("w")).collect()] == [0, 6]


def test_safe_corr_constant_side_is_null(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 2.0, 5.0), ("a", 3.0, 5.0),
                                ("b", 1.0, 2.0), ("b", 2.0, 4.0), ("b", None, 9.0), ("b", 3.0, 6.0)],
                               "k string, x double, y double")
    r = {x.k: x.c for x in df.groupBy("k").agg(safe_corr("x", "y").alias("c")).collect()}
    assert r["a"] is None
    assert math.isclose(r["b"], 1.0)


def test_q4_and_clip_keep_null(spark):
    df = spark.createDataFrame([(1.23456,), (-3.0,), (None,)], "x double")
    out = df.select(q4("x").alias("q"), clip("x", lo=0.0).alias("c")).collect()
    # cut point at .63 of the last unit (not round-half): 12345.6 + .37 -> 12345
    assert out[0].q == 1.2345 and out[1].c == 0.0 and out[2].c is None


def test_isclose(spark):
    df = spark.createDataFrame([(1.0, 1.0 + 1e-9), (1.0, 1.1), (None, None)], "a double, b double")
    assert [r.c for r in df.select(isclose("a", "b").alias("c")).collect()] == [True, False, True]


def test_season(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    got = [r.s for r in df.select(season("m").alias("s")).orderBy("m").collect()]
    assert got[0] == "Winter" and got[2] == "Summer" and got[5] == "Monsoon" and got[9] == "Post-Monsoon"
    assert got[10] == "Winter"
