"""SparkSession construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile
import threading

from pyspark.sql import SparkSession

# Settings that matter for correctness of every query in the library.
CORE_CONF = {
    # Dates/timestamps are compared with DuckDB, which is zone-naive.
    "spark.sql.session.timeZone": "UTC",
    # AQE: coalesce small shuffle partitions, split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for a ~100 TB run on a large cluster (apply with ``profile="cluster"``).
# Sizing: the panel build shuffles the projected line items (5 columns, ~56 B
# per row in UnsafeRow form) twice, once per join; at 600 billion rows that
# is ~30 TB per shuffle, so ~100k reducers of 256 MB each, coalesced by AQE
# where the data is smaller.  Every later stage works on the stage tables
# (rows = keys x days) and is small.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "100000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "100000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def get_spark(master: str | None = None, app: str = "pricelens",
              shuffle_partitions: int | None = None, extra: dict | None = None,
              profile: str = "local") -> SparkSession:
    """Local/test session, or ``profile="cluster"`` for the large-cluster settings.

    On a cluster the submitted session (master, memory, checkpoint dir) is
    reused; only the SQL settings above are added.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(CORE_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("PRICELENS_DRIVER_MEMORY", "16g"),
    })
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    for k, v in CORE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster sets it to shared storage; only on a local master, where it may be
    unset (tests), do we create one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pricelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


_SHIPPED: set = set()
_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``pricelens`` importable in Python workers (pandas UDF code).

    Zips the package once per SparkContext and registers it with
    ``addPyFile`` so executors on any node can import it (the standard way to
    ship Python code with a Spark job).
    """
    with _SHIPPING:
        _ship(spark)


def _ship(spark: SparkSession) -> None:
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = tempfile.mkdtemp(prefix="pricelens-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "pricelens"), "zip", root_dir=root, base_dir="pricelens")
    sc.addPyFile(archive)
    _SHIPPED.add(key)
