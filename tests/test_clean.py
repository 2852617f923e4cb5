from pyspark.sql import functions as F

from pricelens.operators import clean as C


def test_parse_number_and_date_coerce(spark):
    df = spark.createDataFrame([("1,234.50", "01-02-2024"), ("NR", "31-02-2024"), (None, None), ("NaN", "x")],
                               "n string, d string")
    out = df.select(C.parse_number("n").alias("n"), C.parse_date("d").alias("d")).collect()
    assert out[0].n == 1234.5 and str(out[0].d) == "2024-02-01"
    assert out[1].n is None and out[1].d is None and out[2].n is None
    assert out[3].n is None  # NaN text -> NULL, so comparisons never see a NaN


def test_header_rows_null_safe_and_footer(spark):
    df = spark.createDataFrame([("State/UT", "Date"), ("MH", None), ("Note x", "1"), ("Weighted y", "1"), ("MH", "1")],
                               "State string, Date string")
    out = C.drop_footer_rows(C.drop_header_rows(df, {"State": "State/UT", "Date": "Date"}), "State", ("Note", "Weighted"))
    assert sorted((r.State, r.Date or "") for r in out.collect()) == [("MH", ""), ("MH", "1")]


def test_keep_first_and_audit_with_explicit_order(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 1, 12.0), ("a", 2, 5.0), ("b", 1, 7.0)],
                               "k string, d int, v double")
    kept = C.dedupe_keep_first(df, ["k", "d"], [F.col("v").desc()])
    assert sorted((r.k, r.d, r.v) for r in kept.collect()) == [("a", 1, 12.0), ("a", 2, 5.0), ("b", 1, 7.0)]
    audit = C.duplicate_key_audit(df, ["k", "d"], [F.col("v").desc()]).collect()
    assert len(audit) == 2 and sum(r.kept for r in audit) == 1 and all(r.copies == 2 for r in audit)
    rep = C.duplicate_key_report(df, ["k", "d"]).collect()
    assert [(r.k, r.d, r.copies) for r in rep] == [("a", 1, 2)]


def test_price_order_validity_null_fails(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 1.0, 3.0), (1.0, None, 3.0), (2.0, 2.0, 2.0)],
                               "p_min double, p_modal double, p_max double")
    assert [r.ok for r in df.select(C.price_order_valid().alias("ok")).collect()] == [True, False, False, True]


def test_missing_profile_and_duplicate_count(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    prof = {r.column_name: r.missing for r in C.missing_profile(df).collect()}
    assert prof == {"a": 0, "b": 2}
    assert df.agg(C.duplicate_row_count(df).alias("d")).first().d == 1
