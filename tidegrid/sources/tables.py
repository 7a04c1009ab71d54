"""Readings, ledgers and reference data in the telemetry model, from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.functions.timeutil import DAY, INTERVAL, to_iso


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, user_id, meter_id, partition, event_ms, wh."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "user_id",
        F.concat(F.lit("M"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("meter_id"),
        F.concat(F.lit("SUB-0"), (F.col("user_id") % 4 + 1).cast("string")).alias("partition"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_ms"),
        F.floor(F.col("value") * 100).cast("long").alias("wh"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as delivered: every tenth twice, every twenty-fifth corrected three days later, every fiftieth five days later."""
    e = events(spark, sf_dir).withColumn("ingest_ms", F.col("event_ms") + INTERVAL + (F.col("event_id") * 7919) % 180_000)
    copy = lambda delay, more, source: F.struct(F.lit(delay).cast("long").alias("delay"), F.lit(more).cast("long").alias("more"), F.lit(source).alias("source"))
    every = lambda k, *x: F.when(F.col("event_id") % k == 0, copy(*x))
    copies = F.array(copy(0, 0, "stream"), every(10, 90_000, 0, "stream"), every(25, 3 * DAY, 7, "batch"), every(50, 5 * DAY, 11, "batch"))
    d = e.withColumn("c", F.explode(copies)).filter("c IS NOT NULL")
    return d.select("event_id", "meter_id", "partition", "event_ms", (F.col("wh") + F.col("c.more")).alias("wh"), (F.col("ingest_ms") + F.col("c.delay")).alias("ingest_ms"), F.col("c.source").alias("source"))


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt out evenly if they come in fewer parts than there are cores, as from one small file; else as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """deliveries as payloads of three generations, some of them unfit."""
    d = spread(deliveries(spark, sf_dir))
    k, wh, iso = F.col("event_id"), F.col("wh").cast("string"), to_iso(F.col("event_ms"))
    unit = F.when(k % 97 == 0, "MJ").otherwise("Wh")
    value = F.when(k % 83 == 0, F.concat(F.lit("-"), (F.col("wh") + 1).cast("string"))).when(k % 71 == 0, F.concat(wh, F.lit(".5"))).otherwise(wh)
    fw1 = F.format_string('{"v":1,"mid":"%s","ts":%d,"wh":%s}', "meter_id", F.expr("event_ms div 1000"), value)
    fw2 = F.format_string('{"schema":"2","meter_id":"%s","timestamp":"%s","energy":{"value":%s,"unit":"%s"}}', F.col("meter_id"), iso, value, unit)
    fw3 = F.format_string('{"schemaVersion":"3.0","meter":{"id":"%s"},"interval":{"start":"%s"},"energy":{"value":%s,"unit":"%s"}}', F.col("meter_id"), iso, value, unit)
    raw = F.when(k % 3 == 0, fw1).when(k % 3 == 1, fw2).otherwise(fw3)
    raw = F.when(k % 79 == 0, F.concat(raw, F.lit(" x"))).when(k % 73 == 0, F.regexp_replace(raw, r'"M(\d+)"', '1$1')).otherwise(raw)
    ingest = F.when(k % 89 == 0, F.col("event_ms") - 3_600_000).otherwise(F.col("ingest_ms"))
    return d.select("event_id", raw.alias("raw"), ingest.alias("ingest_ms"), F.when(k % 101 == 0, "radio").otherwise(F.col("source")).alias("source"), "partition")


def partitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f"SUB-0{k + 1}", k) for k in range(4)], "partition string, decl_ord int")


def versions(frame: DataFrame, key: str, at: str) -> DataFrame:
    """valid_from and valid_to (half-open, null while open) of the rows of a history, one row for a key and instant."""
    return frame.withColumn("valid_from", F.col(at)).withColumn("valid_to", F.lead(at).over(Window.partitionBy(key).orderBy(at)))


def tariffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price history by meter: customers' orders, the largest order key of a day counting."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey"), F.col("o_orderdate").cast("timestamp").alias("at"), "o_orderkey")
    o = o.groupBy("o_custkey", "at").agg(F.max("o_orderkey").alias("k"))
    return versions(o, "o_custkey", "at").select("o_custkey", "valid_from", "valid_to", F.col("k").alias("tariff"), (F.col("k") % 30 + 10).cast("long").alias("price"))
