"""Shared helpers of the training-data operators: tables, folders, columns."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.session import checkpoint_dir, ship_package

#: Stands for a null document id inside the operators; it sorts before every other id.
NULL_ID = -(2**63)


def prepare(spark: SparkSession) -> None:
    """Ship the package to the executors; drop a query's shuffle files when it ends;
    small Arrow batches, since a row may hold a long text."""
    ship_package(spark)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` under spark.checkpoint.dir and read it back: cuts the lineage
    with a table that every executor can read again after a loss."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete a table of :func:`stored` that nothing will read again."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator needs, so others with clashing names never meet it."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                       F.col("text").cast("string").alias("text"), *more)


def real_id(c) -> F.Column:
    """Back from :data:`NULL_ID` to null."""
    return F.when(c != F.lit(NULL_ID), c)


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts; sizes batches and buckets, never limits the work."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def pieces(total: float, each: float, least: int = 1) -> int:
    """How many parts of about ``each`` make up ``total``."""
    return max(least, int(-(-total // each)))


def id_ranges(docs: DataFrame, each_bytes: int = 8_000_000, most: int = 20_000) -> tuple[DataFrame, int]:
    """``docs`` with ``part``: ranges of doc_id, ascending, of about equal row counts.

    One part per ``each_bytes`` of text, at most ``most`` (so that a row per part
    may travel to the driver); larger data makes larger parts, which only spill more.
    """
    n = min(pieces(text_bytes(docs), each_bytes), most)
    docs = docs.withColumn("_rank", F.col("doc_id").cast("double"))
    cuts = sorted(set(docs.stat.approxQuantile("_rank", [k / n for k in range(1, n)], max(1e-4, 1 / (4 * n))))) if n > 1 else []
    if cuts:
        inf = float("inf")
        docs = Bucketizer(splits=[-inf, *cuts, inf], inputCol="_rank", outputCol="part").transform(docs)
    else:
        docs = docs.withColumn("part", F.lit(0))
    return docs.withColumn("part", F.col("part").cast("int")).drop("_rank"), len(cuts) + 1
