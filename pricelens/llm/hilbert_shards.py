"""Operator 7: sharding along a Hilbert curve [native: DataFrame functions only].

Three metadata dimensions are cut into 16 steps each, numbers at their quantiles
and strings by the rank of the whole value among all rows; the
4,096 cells are ordered by a Hilbert curve, so rows near each other on it are
near in every dimension, and equal runs of the order make the shards, whose
files then prune by any of the dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelens.llm.common import prepare, stored

BITS = 4
STEPS = 1 << BITS
#: Groups of a cell's rows: by text, so that equal texts lie together, then by id.
TEXT_GROUPS = 64
ID_GROUPS = 64


#: Skilling's transform of the cell's coordinates, each step named once by a one-element array.
_CURVE = """
transform(array(aggregate(steps, array(x, y, z), (a, s) -> transform(a, (v, j) ->
    CASE WHEN j = 0 THEN if((a[s.i] & s.q) != 0, v ^ (s.q - 1), v ^ ((v ^ a[s.i]) & (s.q - 1)))
         WHEN j = s.i AND (a[s.i] & s.q) = 0 THEN v ^ ((a[0] ^ v) & (s.q - 1))
         ELSE v END))),
  a -> transform(array(array(a[0], a[1] ^ a[0], a[2] ^ a[1] ^ a[0])),
  g -> transform(array(transform(g, v -> v ^ aggregate(levels, 0, (t, q) -> if((g[2] & q) != 0, t ^ (q - 1), t)))),
  h -> aggregate(bits, 0, (c, k) -> c | shiftleft(shiftright(h[2 - k % 3], k div 3) & 1, k)))[0])[0])[0]
"""


def curve_table(spark: SparkSession) -> DataFrame:
    """(cell, curve): the Hilbert index of each of the 16**3 cells (x * 256 + y * 16 + z)."""
    levels = [1 << b for b in range(BITS - 1, 0, -1)]
    steps = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q in levels for i in range(3)])
    t = spark.range(STEPS**3).select(F.col("id").cast("int").alias("cell"))
    t = t.select("cell", F.shiftright("cell", 2 * BITS).alias("x"), F.shiftright("cell", BITS).bitwiseAND(STEPS - 1).alias("y"), F.col("cell").bitwiseAND(STEPS - 1).alias("z"),
                 steps.alias("steps"), F.array(*map(F.lit, levels)).alias("levels"), F.array(*map(F.lit, range(3 * BITS))).alias("bits"))
    return t.select("cell", F.expr(_CURVE.replace("k div 3", "int(k div 3)")).cast("int").alias("curve"))


def metadata_dimensions(docs: DataFrame) -> list[Column]:
    """Source, language (whole strings) and size; a null is the smallest value."""
    return [*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang")), F.coalesce(F.octet_length("text"), F.lit(0)).cast("double")]


def value_steps(values: DataFrame) -> DataFrame:
    """(value, step): floor(16 * rows with a smaller value / all rows) per distinct string.

    The values are sorted in ranges, so the running count of many of them is no
    task's work alone.
    """
    counts = values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).repartitionByRange("value").withColumn("part", F.spark_partition_id())
    # the ranges may differ from run to run: they are written once
    counts = stored(counts, "shard-values")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    smaller = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("k", F.coalesce(F.sum("n").over(smaller), F.lit(0))).join(F.broadcast(parts), "part")
    total = counts.agg(F.sum("n").alias("total"))
    return ranked.join(F.broadcast(total), F.lit(True)).select("value", F.floor(STEPS * (F.col("part_start") + F.col("k")) / F.col("total")).cast("int").alias("step"))


def hilbert_shards(docs: DataFrame, shards: int = 8, dimensions: list[Column] | None = None) -> DataFrame:
    """Assign every row a shard and a slot; shard row counts differ by one at most (law ``rows``).

    doc_id, size, text_crc32, law, shard, slot, grown_shard, curve.  The order is
    (curve, text group, id group, text hash, id); a cell's groups spread a hot
    cell or a hot text over many tasks.  Nulls are the smallest value of a
    dimension and an empty text; equal rows take neighbouring slots; an empty
    table gives an empty result.  Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    dims = dimensions or metadata_dimensions(docs)
    blank = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select("doc_id", *(d.alias(f"d{i}") for i, d in enumerate(dims)), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(blank, "UTF-8")).alias("text_crc32"), F.xxhash64(blank).alias("text_hash"))
    kinds = dict(base.dtypes)
    words = [i for i in range(3) if kinds[f"d{i}"] == "string"]
    numbers = [i for i in range(3) if i not in words]
    rows = base
    for i in words:
        steps = stored(value_steps(docs.select(dims[i].alias("value"))), "shard-steps").select(F.col("value").alias(f"d{i}"), F.col("step").alias(f"s{i}"))
        rows = rows.join(steps, f"d{i}")
    if numbers:
        # approximate quantiles may differ from run to run: they are written once, and so are the cells
        cuts = stored(base.agg(*(F.percentile_approx(f"d{i}", [k / STEPS for k in range(1, STEPS)], 1000).alias(f"c{i}") for i in numbers)), "shard-cuts")
        rows = rows.join(F.broadcast(cuts), F.lit(True))
    step = [F.col(f"s{i}") if i in words else F.expr(f"size(filter(array_distinct(c{i}), c -> c < d{i}))") for i in range(3)]
    cell = step[0] * (STEPS * STEPS) + step[1] * STEPS + step[2]
    rows = rows.withColumn("cell", cell.cast("int")).join(F.broadcast(curve_table(spark)), "cell")
    rows = stored(rows.select("doc_id", "size", "text_crc32", "text_hash", "curve", F.pmod("text_hash", F.lit(TEXT_GROUPS)).cast("int").alias("g1"),
                              F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(7)), F.lit(ID_GROUPS)).cast("int").alias("g2")), "shard-rows")
    # where each group starts: counts by cell (4,096 rows at most), then by group within its cell
    groups = stored(rows.groupBy("curve", "g1", "g2").agg(F.count(F.lit(1)).alias("n")), "shard-groups")
    cells = groups.groupBy("curve").agg(F.sum("n").alias("n"))
    up_to = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("curve", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("cell_start"))
    inner = Window.partitionBy("curve").orderBy("g1", "g2").rowsBetween(Window.unboundedPreceding, -1)
    groups = (groups.select("curve", "g1", "g2", F.coalesce(F.sum("n").over(inner), F.lit(0)).alias("group_start"))
              .join(F.broadcast(cells), "curve").select("curve", "g1", "g2", (F.col("cell_start") + F.col("group_start")).alias("begin")))
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    own = Window.partitionBy("curve", "g1", "g2").orderBy("text_hash", "doc_id", "size")
    ranked = rows.withColumn("k", F.row_number().over(own) - 1).join(groups, ["curve", "g1", "g2"]).join(F.broadcast(total), F.lit(True))
    place = F.col("begin") + F.col("k")
    # the first (total mod shards) shards hold one row more
    small = F.floor(F.col("total") / shards)
    larger = F.col("total") % shards
    edge = larger * (small + 1)
    shard = F.when(F.col("place") < edge, F.floor(F.col("place") / (small + 1))).otherwise(larger + F.floor((F.col("place") - edge) / F.greatest(small, F.lit(1))))
    start = F.col("shard") * small + F.least(F.col("shard"), larger)
    return (ranked.withColumn("place", place).withColumn("shard", shard.cast("int"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("place") - start).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "curve"))


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """Write ``docs`` to one folder per shard, rows in curve order, for file pruning."""
    placed = hilbert_shards(docs, shards).select(F.col("doc_id").alias("_id"), "shard", "slot")
    rows = docs.join(placed, docs["doc_id"].eqNullSafe(placed["_id"])).drop("_id")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
