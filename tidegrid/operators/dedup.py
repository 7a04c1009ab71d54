"""Collapse of redeliveries and corrections: equal payloads are one, the newest payload wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["meter_id", "interval_start_ms"]


def representatives(readings: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each payload of a key: its earliest delivery, and how many there were. Partial aggregation applies."""
    order = F.struct("ingest_ms", "event_ms", "firmware", "source")
    first = F.min_by(F.struct("energy_wh", "ingest_ms", "event_ms", "firmware", "source"), order)
    return readings.groupBy(*keys, "payload_hash").agg(first.alias("r"), F.count(F.lit(1)).alias("n"))


def collapsed(readings: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """One row a key: the winner, readings, duplicates suppressed and the superseded energies in order of arrival."""
    entry = F.struct(F.col("r.ingest_ms").alias("ingest_ms"), F.col("payload_hash").alias("payload_hash"), F.col("r.energy_wh").alias("energy_wh"), F.col("r.source").alias("source"))
    g = representatives(readings, keys).groupBy(*keys).agg(F.max(entry).alias("w"), F.sum("n").alias("readings"), (F.sum("n") - F.count(F.lit(1))).alias("duplicates_suppressed"), F.array_sort(F.collect_list(entry)).alias("_all"))
    return g.select(*keys, F.col("w.energy_wh").alias("energy_wh"), F.col("w.ingest_ms").alias("ingest_ms"), F.col("w.payload_hash").alias("payload_hash"), "readings", "duplicates_suppressed", F.transform(F.expr("slice(_all, 1, size(_all) - 1)"), lambda x: x["energy_wh"]).alias("superseded"))
