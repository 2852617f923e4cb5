import datetime as dt

from pyspark.sql import functions as F

from paths import SF_SMALL
from pricelens.ml import data as D
from pricelens.ml import regress as R
from pricelens.ml.serve import score_requests
from pricelens.operators.joins import code_map
from pricelens.sources.adapter import price_panel
from pricelens.sources.sinks import write_predictions

SMALL_GBT = R.TreeSpec(kind="boost", trees=5, depth=3, step=0.2)


def test_request_validation_and_scoring(spark, tmp_path):
    mp = D.model_panel(spark, SF_SMALL)
    model = R.fit(mp, SMALL_GBT)
    panel = price_panel(spark, SF_SMALL)
    last = panel.agg(F.max("date")).first()[0]
    first = panel.agg(F.min("date")).first()[0]
    key = panel.select("commodity", "district").first()
    req = spark.createDataFrame([
        (last + dt.timedelta(1), key.district, key.commodity, 10.0, 30.0, 20.0, 0.0, 5.0),    # valid
        (last + dt.timedelta(1), key.district, key.commodity, -1.0, 30.0, 20.0, 0.0, 5.0),    # bad arrival
        (last + dt.timedelta(1), "ATLANTIS", key.commodity, 10.0, 30.0, 20.0, 0.0, 5.0),      # unknown district
        (first + dt.timedelta(1), key.district, key.commodity, 10.0, 30.0, 20.0, 0.0, 5.0),   # too little history
    ], "date date, district string, commodity string, arrival double, max_temp double, min_temp double, "
       "rainfall_mm double, wind double")
    out = {(r.district, r.arrival, r.date): r for r in score_requests(req, panel, model).collect()}
    ok = out[(key.district, 10.0, last + dt.timedelta(1))]
    assert ok.error is None and ok.predicted_price >= 0 and ok.history_rows >= 30
    assert out[(key.district, -1.0, last + dt.timedelta(1))].error.startswith("Arrival")
    assert out[("ATLANTIS", 10.0, last + dt.timedelta(1))].error.startswith("Unknown")
    short = out[(key.district, 10.0, first + dt.timedelta(1))]
    assert "history" in short.error and short.predicted_price is None
    write_predictions(R.predict(model, mp), str(tmp_path / "pred"))
    back = spark.read.parquet(str(tmp_path / "pred"))
    assert back.count() == mp.count() and "error" in back.columns


def test_form_field_validation(spark):
    from pricelens.ml.serve import MESSAGES, validate
    known = spark.createDataFrame([("X", "D")], "commodity string, district string")
    req = spark.createDataFrame([
        ("X", "D", 1.0, 0.0, 1.0, 2024, 13, 1), ("X", "D", 1.0, 0.0, 1.0, 2024, 4, 31),
        ("X", "D", 1.0, 0.0, 1.0, 2024, 4, 32), ("X", "D", 1.0, 0.0, -1.0, 2024, 4, 1),
        ("X", "D", 1.0, 0.0, 1.0, 2024, 2, 29), ("Y", "D", 1.0, 0.0, 1.0, 2024, 2, 28)],
        "commodity string, district string, arrival double, rainfall_mm double, wind double, year int, month int, day int")
    got = [r.error for r in validate(req, known).orderBy("commodity", "month", "day", "wind").collect()]
    assert sorted(map(str, got)) == sorted(map(str, [MESSAGES["wind"], MESSAGES["date"], MESSAGES["day"],
                                                    MESSAGES["month"], None, MESSAGES["unknown"]]))


def test_unseen_category_policies(spark):
    train = spark.createDataFrame([("b",), ("c",)], "district string")
    test = spark.createDataFrame([("a",), ("c",)], "district string")
    first = {r.district for r in D.unseen_to_first(test, train, "district").collect()}
    assert first == {"b", "c"}
    labels = spark.createDataFrame([("b", 0), ("c", 1)], "district string, code int")
    codes = {r.district: r.code for r in code_map(test, labels, "district").collect()}
    assert codes == {"a": -1, "c": 1}
    idx = D.indexers(["district"], "keep")[0].fit(train)
    got = {r.district: r.district_code for r in idx.transform(test).collect()}
    assert got == {"a": 2.0, "c": 1.0}  # keep: unseen -> numLabels
