"""Operator 5: packing token sequences by minimum bin slack.

A document longer than a sequence is cut into full sequences and a rest.  The
rests are packed from the multiset of their lengths alone (a count per length,
so at most ``capacity`` numbers): the longest rest opens a sequence, a bitset
subset-sum programme over the remaining lengths finds the filling closest to
capacity, its counts are read back, and the pattern is used as often as the
counts allow.  The plan then deals places to the rests by their rank within
their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import id_text, prepare, real_id, stored
from pricelens.llm.tokens import default_vocabulary, encoded

CAPACITY = 2048
#: Groups that ranks are counted in, so that a hot length is spread over tasks.
GROUPS = 64


def best_filling(room: int, counts: dict[int, int]) -> dict[int, int]:
    """The multiset of lengths (at most ``counts`` of each) with the largest sum up to ``room``."""
    reach, full, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((k for k in counts if k <= room), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            copies = min(copies, left)
            steps.append((length, copies, reach))
            reach |= reach << length * copies & full
            left, copies = left - copies, 2 * copies
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, copies, before in reversed(steps):
        if not before >> at & 1:
            at -= length * copies
            used[length] = used.get(length, 0) + copies
    return used


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: copies}) patterns that use up ``counts``; each ends a length at least."""
    left, plan = {k: n for k, n in counts.items() if n > 0}, []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        used = best_filling(capacity - longest, {k: n for k, n in rest.items() if n})
        used[longest] = used.get(longest, 0) + 1
        times = min(left[k] // c for k, c in used.items())
        for k, c in used.items():
            left[k] -= c * times
            if not left[k]:
                del left[k]
        plan.append((times, used))
    return plan


def places(plan: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies a sequence, first sequence, offset) rows of a plan."""
    rows, cursor, sequence = [], {}, 0
    for times, used in plan:
        offset = 0
        for length in sorted(used, reverse=True):
            copies, first = used[length], cursor.get(length, 0)
            rows.append((length, first, first + copies * times, copies, sequence, offset))
            cursor[length] = first + copies * times
            offset += copies * length
        sequence += times
    return rows


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, doc_tokens, crcs): crc32 of each full piece and of the rest, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, crcs = [], []
            for _, _, ids, bounds in encoded(b.column("text"), vocabulary, end_id):
                data = memoryview(ids.astype("<u4").tobytes())
                for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    total.append(z - a)
                    crcs.append([zlib.crc32(data[4 * k : 4 * min(k + capacity, z)]) for k in range(a, z, capacity)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(total, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))], names=["doc_id", "doc_tokens", "crcs"])

    return docs.mapInArrow(run, "doc_id long, doc_tokens long, crcs array<long>")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, end_id: int = 1) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece.

    Every id lies in one piece; a sequence's pieces fill it from 0 without gaps.
    A null text is empty (its end id alone); repeated rows are packed each; a
    null id stays null; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = stored(token_pieces(id_text(docs), vocabulary or default_vocabulary(), end_id, capacity), "pieces")
    rows = rows.select("doc_id", "doc_tokens", "crcs", F.floor(F.col("doc_tokens") / capacity).alias("full"), (F.col("doc_tokens") % capacity).alias("rest"),
                       F.xxhash64("doc_id", "doc_tokens", "crcs").alias("key"))
    # the rests: a count per length reaches the driver, at most one row for each length below capacity
    rests = rows.filter("rest > 0").withColumn("g", F.pmod("key", F.lit(GROUPS)).cast("int"))
    counts = stored(rests.groupBy("rest", "g").agg(F.count(F.lit(1)).alias("n")), "rest-counts")
    plan = minimum_bin_slack({r.rest: r.n for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}, capacity)
    packed = sum(times for times, _ in plan)
    table = spark.createDataFrame(places(plan), "rest long, lo long, hi long, copies long, first long, at long")
    before = Window.partitionBy("rest").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("rest", "g", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    rank = F.row_number().over(Window.partitionBy("rest", "g").orderBy("key", "doc_id")) - 1
    ranked = rests.withColumn("k", rank).join(begins, ["rest", "g"]).withColumn("rank", F.col("begin") + F.col("k"))
    k = F.col("rank") - F.col("lo")
    rest_pieces = (ranked.join(F.broadcast(table.withColumnRenamed("rest", "_rest")), (F.col("rest") == F.col("_rest")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
                   .select("doc_id", (F.col("full") * capacity).alias("start"), F.col("rest").alias("length"), F.element_at("crcs", -1).alias("ids_crc32"), "doc_tokens",
                           (F.col("first") + F.floor(k / F.col("copies"))).cast("long").alias("sequence_id"), (F.col("at") + (k % F.col("copies")) * F.col("rest")).cast("long").alias("offset")))
    # the full pieces: numbered on from the packed sequences
    whole = rows.filter("full > 0").withColumn("g", F.pmod(F.col("key"), F.lit(16 * GROUPS)).cast("int"))
    groups = whole.groupBy("g").agg(F.sum("full").alias("n"))
    groups = groups.select("g", F.coalesce(F.sum("n").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begin"))
    inner = Window.partitionBy("g").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.withColumn("k", F.coalesce(F.sum("full").over(inner), F.lit(0))).join(F.broadcast(groups), "g")
    whole_pieces = (whole.select("doc_id", "doc_tokens", (F.lit(packed) + F.col("begin") + F.col("k")).alias("s"), F.posexplode(F.expr("slice(crcs, 1, int(full))")).alias("i", "ids_crc32"))
                    .select("doc_id", (F.col("i") * capacity).cast("long").alias("start"), F.lit(capacity).cast("long").alias("length"), "ids_crc32", "doc_tokens",
                            (F.col("s") + F.col("i")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    return rest_pieces.unionByName(whole_pieces).withColumn("doc_id", real_id(F.col("doc_id")))
