"""File sources and sinks: landing JSONL, CSV populations, partitioned tables, upserts, compaction."""

from __future__ import annotations

import time
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def _path(spark: SparkSession, path: str):
    """A path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, glob: str | None = None, without: str | None = None) -> DataFrame:
    """Rows of JSON lines under path, of a declared schema; lines that don't start an object or don't parse are skipped.

    glob: names of files to read; without: a pattern of names not to read.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(path).filter(F.col("value").startswith("{"))
    if without:
        lines = lines.filter(~F.col("_metadata.file_name").rlike(without))
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_bad = StructType([*wanted.fields, StructField("_bad", StringType())])
    rows = lines.select(F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return rows.filter("r._bad IS NULL").select("r.*").drop("_bad")


def read_landed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame | None:
    """None if nothing has landed under path; an error if files are there but no rows."""
    if not exists(spark, path):
        return None
    rows = read_jsonl(spark, path, schema)
    if rows.isEmpty():
        raise ValueError(f"files but no rows under {path}")
    return rows


def read_telemetry(spark: SparkSession, path: str, since_ms: int) -> DataFrame:
    """Load samples of files changed since an instant, with headroom_w and event_day; what lacks a field is left out."""
    since = datetime.fromtimestamp(since_ms / 1000, UTC).strftime("%Y-%m-%dT%H:%M:%S")
    raw = spark.read.option("recursiveFileLookup", "true").option("modifiedAfter", since).schema("event_time string, ingest_time string, substation_id string, load_w long, limit_w long").json(path)
    second = lambda c: F.try_to_timestamp(F.substring(c, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    rows = raw.withColumns({"event_time": second("event_time"), "ingest_time": second("ingest_time")}).dropna()
    return rows.withColumns({"headroom_w": F.col("limit_w") - F.col("load_w"), "event_day": F.date_format("event_time", "yyyy-MM-dd")})


#: Landed outcome lines, in which energy is text so that no reader rounds it.
LANDED = """kind string, meter string, interval_start long, energy_wh string, readings long, duplicates_suppressed long, corrections_absorbed long, closed_at long, first_seen_at long,
    revision int, supersedes long, restatement_cause string, clock_status string, idle_partitions array<string>, lineage_id string"""


def silver(landed: DataFrame) -> DataFrame:
    """Landed outcome lines with the types of the silver table, one for each window: the newest revision, then closing, then lineage."""
    at = lambda c: F.timestamp_millis(c).alias(c)
    rows = landed.filter(F.col("kind").isin("published", "restated", "confirmed") & F.col("meter").isNotNull())
    typed = rows.select(
        F.col("meter").alias("meter_id"), at("interval_start"), F.col("energy_wh").try_cast("long").alias("energy_wh"), "readings", "duplicates_suppressed", "corrections_absorbed", at("closed_at"), at("first_seen_at"),
        "clock_status", "idle_partitions", "revision", "supersedes", "restatement_cause", "lineage_id", "kind",
    )
    # Of one revision the row that states it comes before what confirmed it.
    row = F.struct("revision", "closed_at", F.col("kind") != "confirmed", "lineage_id")
    rest = [c for c in typed.columns if c not in ("meter_id", "interval_start", "kind")]
    return typed.groupBy("meter_id", "interval_start").agg(F.max_by(F.struct(*rest), row).alias("r")).select("meter_id", "interval_start", "r.*").withColumn("merged_at", F.current_timestamp())


def read_csv(spark: SparkSession, path: str, schema: str, required: list[str]) -> DataFrame:
    header = spark.read.option("header", "true").csv(path).columns
    if missing := [c for c in required if c not in header]:
        raise ValueError(f"missing columns: {missing}")
    return spark.read.option("header", "true").schema(schema).csv(path).select(*required)


def write_jsonl(df: DataFrame, path: str, mode: str = "append", sort_keys: bool = False, rows_per_file: int = 0) -> None:
    """One line a row, null fields kept; a file is closed after rows_per_file lines."""
    df = df.select(*sorted(df.columns)) if sort_keys else df
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.option("maxRecordsPerFile", rows_per_file).mode(mode).text(path)


def rolling_jsonl(stream: DataFrame, path: str, checkpoint: str, every: str = "60 seconds", **trigger):
    """A started query that writes a stream as JSON lines, a roll of files each trigger."""
    lines = stream.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    return lines.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": every})).start()


def write_by_day(df: DataFrame, path: str, day: str, mode: str = "append") -> None:
    df.repartition(F.col(day)).write.mode(mode).partitionBy(day).parquet(path)


def upserted(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """target with source merged in: newest source row a key; a tie in revision leaves the target."""
    new = source.groupBy(*keys).agg(F.max(F.struct("revision", *[c for c in target.columns if c not in (*keys, "revision")])).alias("s"))
    new = new.select(*keys, *[F.col(f"s.{c}").alias(c) for c in target.columns if c not in keys])
    both = target.withColumn("_t", F.lit(1)).unionByName(new.withColumn("_t", F.lit(0)))
    rest = [c for c in target.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("revision", "_t")).alias("x")).select(*keys, *[F.col(f"x.{c}").alias(c) for c in rest]).select(*target.columns)


def merged_hours(gold: DataFrame, silver: DataFrame, since) -> DataFrame:
    """Hours of gold (meter_id, hour_start, ...), recomputed as a whole where a window of theirs was merged after since.

    By merged_at and not by closing time, which a restatement leaves as it was.
    """
    hour = F.date_trunc("hour", "interval_start")
    rows = silver.withColumn("hour_start", hour)
    touched = rows.filter(F.col("merged_at") > since).select("meter_id", "hour_start").distinct()
    again = rows.join(touched, ["meter_id", "hour_start"], "left_semi").groupBy("meter_id", "hour_start").agg(
        F.sum("energy_wh").alias("energy_wh"), F.count(F.lit(1)).alias("intervals"), F.max("revision").alias("revision"), F.bool_or(F.coalesce(F.cardinality("idle_partitions") > 0, F.lit(False))).alias("with_idle"), (F.count(F.lit(1)) == 4).alias("is_complete")
    )
    return gold.join(touched, ["meter_id", "hour_start"], "left_anti").unionByName(again)


def retried(action, attempts: int = 4, wait_s: float = 15.0, sleep=time.sleep):
    """action(), tried again after a growing pause while it fails; the last failure is raised."""
    for k in range(1, attempts + 1):
        try:
            return action()
        except Exception:
            if k == attempts:
                raise
            sleep(wait_s * k)


def appended_once(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """target with the source rows whose snapshot isn't in target yet."""
    return target.unionByName(source.join(target.select(key).distinct(), key, "left_anti").select(*target.columns))


def existing(spark: SparkSession, tables: list[str]) -> list[str]:
    """Those of tables that are there; an error if none is."""
    if found := [t for t in tables if spark.catalog.tableExists(t)]:
        return found
    raise ValueError(f"none of {tables} exists")


def compact(spark: SparkSession, path: str, out: str, target_bytes: int = 512 << 20) -> None:
    """path rewritten to out in files of about target_bytes."""
    p, fs = _path(spark, path)
    size = fs.getContentSummary(p).getLength()
    spark.read.parquet(path).repartition(max(1, -(-size // target_bytes))).write.parquet(out)


def expired(snapshots: DataFrame, tags: DataFrame, now_ms: int, keep: int = 10, age_ms: int = 30 * 86_400_000) -> DataFrame:
    """Snapshots that may go: older than age, not among the newest keep, and not tagged."""
    old = snapshots.filter(F.col("at_ms") < now_ms - age_ms)
    newest = snapshots.orderBy(F.desc("at_ms")).limit(keep).select("snapshot_id")
    return old.join(newest, "snapshot_id", "left_anti").join(tags, "snapshot_id", "left_anti")


def expiry_code(before: DataFrame, after: DataFrame) -> int:
    """1 if a tag (tag, snapshot_id) that was there before an expiry is gone after it, else 0."""
    return int(not before.join(after, ["tag", "snapshot_id"], "left_anti").isEmpty())


def orphans(files: DataFrame, manifest: DataFrame, now_ms: int, age_ms: int = 3 * 86_400_000) -> DataFrame:
    """Files (path, changed_ms) that no manifest (path) names, of at least age; an age below three days is refused."""
    if age_ms < 3 * 86_400_000:
        raise ValueError("younger files may belong to a write that has not ended")
    return files.filter(F.col("changed_ms") <= now_ms - age_ms).join(manifest.select("path").distinct(), "path", "left_anti")
