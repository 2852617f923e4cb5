"""Asking about keys across the corpus: documents in batches, keys in buckets.

Documents are dealt to batches by a hash of their id and text, so that an id many
rows share is spread; rows equal in both that would fill a batch are taken once
and their results repeated.  A task holds one batch,
sends each distinct key of it once to the key's bucket, packed as numpy arrays,
and gets an answer per key back, so a key that is hot in the corpus costs one
entry per batch and nothing is sent to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import stored

ASKS = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("vals", pa.binary())])
ASKS_DDL = "batch long, bucket int, keys binary, vals binary"
ANSWERS = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("answer", pa.binary())])
ANSWERS_DDL = "batch long, bucket int, answer binary"


#: Copies of a row that one task writes.
REPEATS = 1000


def row_key() -> Column:
    """Names a row by id and text."""
    return F.xxhash64("doc_id", "text")


def with_batch(docs: DataFrame, n: int) -> DataFrame:
    return docs.withColumn("batch", F.pmod(row_key(), F.lit(n)))


def once(docs: DataFrame, each_bytes: int) -> tuple[DataFrame, int, bool]:
    """(doc_id, text, times), the bytes of all texts, and whether any row stands for several.

    Rows equal in id and text become one with their number as ``times`` if together they
    hold more than ``each_bytes``; there are fewer such rows than bytes / each_bytes.
    """
    keyed = docs.select("doc_id", "text", row_key().alias("_key"))
    sizes = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    hot = (F.col("n") > 1) & (F.col("bytes") > each_bytes)
    total, several = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count_if(hot)).first()
    if not several:
        return docs.select("doc_id", "text", F.lit(1).cast("long").alias("times")), total, False
    keys = stored(sizes.filter(hot).select("_key"), "hot-rows")
    folded = keyed.join(F.broadcast(keys), "_key", "left_semi").groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("times"))
    rest = keyed.join(F.broadcast(keys), "_key", "left_anti").select("doc_id", "text", F.lit(1).cast("long").alias("times"))
    return rest.unionByName(folded), total, True


def again(results: DataFrame, several: bool) -> DataFrame:
    """Every result as often as its row stood in the table, in runs of :data:`REPEATS`."""
    if several:
        runs = results.withColumn("_run", F.explode(F.expr(f"sequence(0L, (times - 1) div {REPEATS})"))).repartition(F.xxhash64("doc_id", "_run"))
        results = runs.withColumn("_copy", F.explode(F.expr(f"sequence(1L, least({REPEATS}L, times - _run * {REPEATS}L))"))).drop("_run", "_copy")
    return results.drop("times")


def bucket_runs(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) over sorted uint64 ``keys``; a bucket is an equal range of keys."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cut = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(keys)]]) if len(keys) else np.zeros(1, np.int64)
    for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        yield int(bucket[a]), a, z


def asks(batch: int, keys: np.ndarray, vals: np.ndarray, buckets: int) -> Iterator[dict]:
    """Rows that ask about sorted distinct ``keys`` with one value each."""
    for k, a, z in bucket_runs(keys, buckets):
        yield {"batch": batch, "bucket": k, "keys": keys[a:z].tobytes(), "vals": vals[a:z].tobytes()}


def answered(keys: np.ndarray, rows: list[dict], buckets: int) -> np.ndarray:
    """The answers (a byte per key) in the order of sorted distinct ``keys``."""
    out = np.zeros(len(keys), np.uint8)
    found = {r["bucket"]: r["answer"] for r in rows}
    for k, a, z in bucket_runs(keys, buckets):
        out[a:z] = np.frombuffer(found[k], np.uint8)
    return out


def answer(questions: DataFrame, decide: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], dtype: str) -> DataFrame:
    """Answer rows per batch and bucket.

    ``decide(group, starts, vals)`` gets all entries sorted by key: the key's
    number of each entry, where each key's entries start, and the values; it
    returns a byte for each entry.
    """
    def run(t: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x.as_py(), np.uint64) for x in t.column("keys")]
        vals = np.concatenate([np.frombuffer(x.as_py(), dtype) for x in t.column("vals")])
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        k = flat[order]
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        out = np.empty(len(k), np.uint8)
        out[order] = decide(np.cumsum(new) - 1, np.flatnonzero(new), vals[order])
        cut = np.concatenate([[0], np.cumsum([len(x) for x in keys])])
        return pa.table([t.column("batch"), t.column("bucket"), pa.array([out[a:z].tobytes() for a, z in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], schema=ANSWERS)

    return questions.groupBy("bucket").applyInArrow(run, ANSWERS_DDL)
