import datetime as dt
import math
import tempfile

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from pricelens.operators.windows import add_change_features
from pricelens.sources.adapter import price_panel
from pricelens.streaming.alerts import PRICE_ROW_SCHEMA, land_price_rows, run_alerts


def _same(a, b):
    return (a is None or a != a) and (b is None or b != b) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("files", [1, 4, 16])
def test_stream_gives_every_panel_day(spark, files):
    base = tempfile.mkdtemp(prefix="pricelens-stream-")
    land_price_rows(spark, SF_SMALL, f"{base}/landing", ranges=2, files=files)
    got = run_alerts(spark, f"{base}/landing", f"{base}/ckpt", f"{base}/partials", files_per_trigger=3).toPandas()
    batch = add_change_features(price_panel(spark, SF_SMALL)).toPandas()
    batch = batch.rename(columns={"date": "day"}).set_index(["commodity", "district", "day"])
    assert len(got) == len(batch)
    for r in got.itertuples():
        b = batch.loc[(r.commodity, r.district, r.day)]
        assert _same(r.modal_price, b.modal_price) and _same(r.arrival, b.arrival) and _same(r.price_change_pct, b.price_change_pct)
    s = got.dropna(subset=["price_change_pct"])
    assert ((s.price_change_pct.abs() >= 20) == s.shock_type.notna()).all()


def _land(spark, path, rows):
    spark.createDataFrame(rows, PRICE_ROW_SCHEMA).coalesce(1).write.parquet(path)


def test_later_landings_correct_days_and_keep_the_previous_price(spark):
    base = tempfile.mkdtemp(prefix="pricelens-stream-late-")
    t = lambda d, h=12: dt.datetime(2024, 1, d, h)
    run = lambda: run_alerts(spark, f"{base}/landing", f"{base}/ckpt", f"{base}/partials").toPandas()
    _land(spark, f"{base}/landing/part=0", [("x", "d", t(1), 100.0, 1.0), ("x", "d", t(1, 13), 110.0, 1.0), ("x", "d", t(2), 150.0, 2.0)])
    x = run().sort_values("day").reset_index(drop=True)
    assert x.modal_price.tolist() == [105.0, 150.0] and x.shock_type[1] == "Price Spike" and x.price_stress[1] == 3
    # a row for a closed day, a day long after it, and another key
    _land(spark, f"{base}/landing/part=1", [("x", "d", t(1, 14), 90.0, 9.0), ("x", "d", t(20), 300.0, 1.0), ("y", "d", t(9), 10.0, 1.0), ("y", "d", t(9), None, None)])
    got = run()
    x = got[got.commodity == "x"].sort_values("day").reset_index(drop=True)
    assert [str(d) for d in x.day] == ["2024-01-01", "2024-01-02", "2024-01-20"]
    assert x.modal_price.tolist() == [100.0, 150.0, 300.0] and x.arrival.tolist() == [11.0, 2.0, 1.0]
    assert abs(x.price_change_pct[2] - 100.0) < 1e-9 and x.shock_type[2] == "Price Spike"
    assert got[got.commodity == "y"].modal_price.tolist() == [10.0]
    assert len(run()) == 4  # nothing new: the same days


def test_a_batch_reads_its_years_and_corrects_the_next_trading_day(spark):
    """Rows read do not follow the history; a correction reaches a trading day two years on; a batch run again changes nothing."""
    from pricelens.streaming.alerts import AlertStore
    reads = []
    for years in (3, 9):
        sink = tempfile.mkdtemp(prefix="pricelens-stream-years-")
        store = AlertStore(spark, sink)
        frame = lambda rows: spark.createDataFrame(rows, PRICE_ROW_SCHEMA)
        history = [("x", "d", dt.datetime(2020 - y, m, 5), 100.0 + m, 1.0) for y in range(years) for m in range(1, 13)]
        store.merge(frame(history), 0)
        store.merge(frame([("x", "d", dt.datetime(2020, 12, 9), 226.0, 1.0)]), 1)
        log = spark.read.json(f"{sink}/_log").filter("batch = 1").first()
        reads.append(log.stored_rows_read)
        assert list(log.years) == [2020]
        last = store.alerts().orderBy(F.desc("day")).first()
        assert abs(last.price_change_pct - (226 / 112 - 1) * 100) < 1e-9
    assert reads == [12, 12]
    sink = tempfile.mkdtemp(prefix="pricelens-stream-gap-")
    store = AlertStore(spark, sink)
    store.merge(frame([("x", "d", dt.datetime(2018, 1, 5), 100.0, 1.0), ("y", "d", dt.datetime(2019, 6, 5), 10.0, 1.0), ("x", "d", dt.datetime(2020, 3, 5), 150.0, 1.0)]), 0)
    late = frame([("x", "d", dt.datetime(2018, 5, 5), 120.0, 1.0)])
    for _ in range(2):  # the second time as after a lost driver
        store.merge(late, 1)
        got = {(r.commodity, str(r.day)): r.price_change_pct for r in store.alerts().collect()}
        assert len(got) == 4 and abs(got["x", "2018-05-05"] - 20) < 1e-9 and abs(got["x", "2020-03-05"] - 25) < 1e-9 and got["y", "2019-06-05"] is None
    store.merge(frame([("y", "d", dt.datetime(2019, 7, 5), 11.0, 1.0)]), 2)
    store.merge(frame([("y", "d", dt.datetime(2019, 8, 5), 11.0, 1.0)]), 3)
    from pricelens.sources.store import names
    assert names(spark, f"{sink}/year=2019") == ["v=2", "v=3"] and store.alerts().count() == 6
