"""Price-shock alerts over a stream of price rows (D1, N21), kept up to date batch by batch.

Input stream rows: commodity, district, ts (event time), unit_price, quantity.
The stored alerts are one table a year of trading days; each year also keeps
its ``ends``: every key's last price so far.  A micro-batch is cut down to daily
sums, and only the years it touches are computed again: their stored days with
the batch's, each day's change against the key's previous trading day, which
for the first one is in the ends of the year before.  Where a year's ends
change, the next year follows, and so on until they do not; so the rows read
follow the batch, not the history.  No row is late: a row for an older day
corrects that day and the key's next trading day.

A version of a year is written under the batch's id and counts once the batch's
mark is there, so a batch that is run again replaces its own files and starts
from the versions before it.  Versions older than the last two are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.functions import safe_div
from pricelens.operators.analyses import SHOCK_THRESHOLD
from pricelens.operators.scores import price_stress
from pricelens.operators.windows import lag, spec
from pricelens.sources.store import names, remove

PRICE_ROW_SCHEMA = "commodity string, district string, ts timestamp, unit_price double, quantity double"
KEYS = ["commodity", "district"]
ENDS_SCHEMA = "commodity string, district string, day date, modal_price double"
ALERT_SCHEMA = "commodity string, district string, day date, price_sum double, price_n long, arrival double, modal_price double, price_change_pct double, price_stress int, shock_type string"


def daily_partials(rows: DataFrame) -> DataFrame:
    """Sums of a batch of price rows per key and day."""
    return (rows.groupBy("commodity", "district", F.to_date("ts").alias("day"))
            .agg(F.sum("unit_price").alias("price_sum"), F.count("unit_price").alias("price_n"), F.sum("quantity").alias("arrival")))


def price_alerts(days: DataFrame, ends: DataFrame) -> DataFrame:
    """Trading days (with their sums) with mean price, change against the key's previous
    day, stress and shock label; ``ends`` holds the keys' last prices before them."""
    d = days.groupBy(*KEYS, "day").agg(F.sum("price_sum").alias("price_sum"), F.sum("price_n").alias("price_n"), F.sum("arrival").alias("arrival"))
    d = d.withColumns({"modal_price": safe_div("price_sum", "price_n"), "_before": F.lit(False)})
    d = d.unionByName(ends.withColumn("_before", F.lit(True)), allowMissingColumns=True)
    d = d.withColumn("price_change_pct", (safe_div("modal_price", lag("modal_price", 1, spec(KEYS, "day"))) - 1) * 100).filter(~F.col("_before")).drop("_before")
    shock = F.when(F.abs("price_change_pct") >= SHOCK_THRESHOLD, F.when(F.col("price_change_pct") > 0, "Price Spike").otherwise("Price Crash"))
    d = d.withColumns({"price_stress": price_stress(F.abs("price_change_pct")).cast("int"), "shock_type": shock})
    return d.select(*[c.split(" ")[0] for c in ALERT_SCHEMA.split(", ")])


def last_prices(alerts: DataFrame, ends: DataFrame) -> DataFrame:
    """Every key's last day and price so far."""
    rows = alerts.select(*KEYS, "day", "modal_price").unionByName(ends)
    last = F.max_by(F.struct("day", "modal_price"), F.struct(F.col("day").isNotNull(), F.col("day")))
    return rows.groupBy(*KEYS).agg(last.alias("_l")).select(*KEYS, "_l.*")


class AlertStore:
    """The years of a sink folder and their versions."""

    def __init__(self, spark: SparkSession, sink: str):
        self.spark, self.sink = spark, sink

    def versions(self, year: int, done: set[int]) -> list[int]:
        return sorted(v for n in names(self.spark, f"{self.sink}/year={year}") if (v := int(n.removeprefix("v="))) in done)

    def years(self, done: set[int]) -> list[int]:
        found = [int(n.removeprefix("year=")) for n in names(self.spark, self.sink) if n.startswith("year=")]
        return sorted(y for y in found if self.versions(y, done))

    def done(self) -> set[int]:
        return {int(n) for n in names(self.spark, f"{self.sink}/_done")}

    def folder(self, year: int, done: set[int]) -> str | None:
        v = self.versions(year, done)
        return f"{self.sink}/year={year}/v={v[-1]}" if v else None

    def table(self, folder: str | None, part: str) -> DataFrame:
        schema = ALERT_SCHEMA if part == "alerts" else ENDS_SCHEMA
        return self.spark.read.schema(schema).parquet(f"{folder}/{part}") if folder else self.spark.createDataFrame([], schema)

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Bring the alerts up to date with a batch of price rows."""
        spark, done = self.spark, {d for d in self.done() if d < batch_id}
        held = f"{self.sink}/_batch/{batch_id}"
        daily_partials(batch).withColumn("year", F.coalesce(F.year("day"), F.lit(0))).write.mode("overwrite").partitionBy("year").parquet(held)
        todo = {int(n.removeprefix("year=")) for n in names(spark, held) if n.startswith("year=")}
        stored, now, read = self.years(done), done | {batch_id}, 0
        touched = []
        while todo:
            year = min(todo)
            todo.discard(year)
            every = sorted({*stored, *touched, year})
            before = [y for y in every if y < year]
            ends = self.table(self.folder(before[-1], now) if before else None, "ends")
            old = self.folder(year, done)
            days = self.table(old, "alerts").select(*KEYS, "day", "price_sum", "price_n", "arrival")
            read += days.count() if old else 0
            if f"year={year}" in names(spark, held):
                days = days.unionByName(spark.read.parquet(f"{held}/year={year}").select(*days.columns))
            new = f"{self.sink}/year={year}/v={batch_id}"
            price_alerts(days, ends).write.mode("overwrite").parquet(f"{new}/alerts")
            last_prices(self.table(new, "alerts"), ends).write.mode("overwrite").parquet(f"{new}/ends")
            touched.append(year)
            after = [y for y in stored if y > year]
            if after and not self.table(new, "ends").exceptAll(self.table(old, "ends")).isEmpty():
                todo.add(after[0])
        log = spark.createDataFrame([(batch_id, touched, read)], "batch long, years array<int>, stored_rows_read long")
        log.coalesce(1).write.mode("overwrite").json(f"{self.sink}/_log/batch={batch_id}")
        spark.range(0).write.mode("overwrite").parquet(f"{self.sink}/_done/{batch_id}")
        remove(spark, held)
        for year in touched:
            for v in self.versions(year, now)[:-2]:
                remove(spark, f"{self.sink}/year={year}/v={v}")

    def alerts(self) -> DataFrame:
        done = self.done()
        found = [f"{self.folder(y, done)}/alerts" for y in self.years(done)]
        rows = self.spark.read.schema(ALERT_SCHEMA).parquet(*found) if found else self.spark.createDataFrame([], ALERT_SCHEMA)
        return rows.drop("price_sum", "price_n")


def land_price_rows(spark: SparkSession, sf_dir: str, path: str, ranges: int = 4, files: int | None = None) -> None:
    """Write the price rows of ``sf_dir`` as landings, one folder per range of ship dates.

    ``files`` splits every landing into that many files; by default Spark's own
    partitioning does.
    """
    from pricelens.sources.adapter import price_rows
    r = price_rows(spark, sf_dir).select("commodity", "district", F.col("date").cast("timestamp").alias("ts"), "unit_price", "quantity")
    b = r.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    lo, hi = (b.select(F.unix_seconds(c).alias(c)).scalar() for c in ("a", "b"))
    part = F.floor(safe_div((F.unix_seconds("ts") - lo).cast("double") * F.lit(float(ranges)), (hi - lo + 1).cast("double"))).cast("int")
    r = r.withColumn("part", part)
    (r.repartition(files) if files else r).write.partitionBy("part").parquet(path)


def run_alerts(spark: SparkSession, landing: str, checkpoint: str, sink: str, files_per_trigger: int | None = None) -> DataFrame:
    """Run the stream over everything landed (availableNow) into ``sink`` and return the alerts.

    Restarting with the same checkpoint and sink takes up new landings only.
    """
    src = spark.readStream.schema(PRICE_ROW_SCHEMA).option("recursiveFileLookup", "true")
    if files_per_trigger:
        src = src.option("maxFilesPerTrigger", files_per_trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        AlertStore(batch.sparkSession, sink).merge(batch, batch_id)

    q = src.parquet(landing).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return AlertStore(spark, sink).alerts()
