"""Arrivals as a stream: normalised batch by batch into tables that a repeated batch overwrites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegrid.operators.normalise import normalised

ARRIVAL = "event_id long, raw string, ingest_ms long, source string, partition string"


def arrival_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(ARRIVAL).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def ingest(stream: DataFrame, folder: str):
    """A started query that writes readings and quarantined rows under folder, by batch; run again, it goes on where it stopped."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = normalised(batch).persist()
        good = rows.filter("reason IS NULL").drop("reason", "raw")
        good.write.mode("overwrite").parquet(f"{folder}/readings/batch={batch_id}")
        rows.filter("reason IS NOT NULL").select("reason", "raw", "ingest_ms").write.mode("overwrite").parquet(f"{folder}/quarantine/batch={batch_id}")
        rows.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
