import os
import tempfile
import threading

import pytest

from pricelens import session
from pricelens.sources import store


def test_rewrite_in_place_is_not_served_from_the_old_table(spark):
    src = tempfile.mkdtemp(prefix="pricelens-store-") + "/t"
    spark.range(5).coalesce(1).write.parquet(src)
    build = lambda: spark.read.parquet(src).selectExpr("sum(id) AS s")
    assert store.materialized(spark, "sum_t", [src], build).first().s == 10
    file = next(f"{src}/{f}" for f in os.listdir(src) if f.startswith("part"))
    other = tempfile.mkdtemp(prefix="pricelens-store-") + "/u"
    spark.range(5).selectExpr("id + 5 AS id").coalesce(1).write.parquet(other)
    new = next(f"{other}/{f}" for f in os.listdir(other) if f.startswith("part"))
    with open(new, "rb") as a, open(file, "wb") as b:
        b.write(a.read())
    crc = f"{src}/.{os.path.basename(file)}.crc"
    with open(f"{other}/.{os.path.basename(new)}.crc", "rb") as a, open(crc, "wb") as b:
        b.write(a.read())
    os.utime(file, (2_000_000_000, 2_000_000_000))
    assert store.materialized(spark, "sum_t", [src], build).first().s == 35


def test_missing_input_raises(spark):
    with pytest.raises(Exception, match="does not exist"):
        store.materialized(spark, "none", ["/tmp/no-such-input-of-pricelens"], lambda: spark.range(1))


def test_two_writers_publish_one_table(spark):
    path = f"{session.checkpoint_dir(spark)}/pricelens_tables/race"
    built = [f"{path}.{k}" for k in "ab"]
    for k, p in enumerate(built):
        spark.range(3 + k).write.parquet(p)
    ts = [threading.Thread(target=store._publish, args=(spark, p, path)) for p in built]
    [t.start() for t in ts]
    [t.join() for t in ts]
    assert spark.read.parquet(path).count() in (3, 4)
    assert not any(store._exists(spark, p) for p in built)


def test_no_machine_local_folder_on_a_cluster():
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
