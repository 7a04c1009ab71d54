"""Hourly, group and priced settlement over newest revisions, as-of joins, reconciliation and diffs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.scalars import derived
from tidegrid.functions.timeutil import HOUR, floor_to, to_iso


def as_of(left: DataFrame, history: DataFrame, key: list[str], at: str, how: str = "left") -> DataFrame:
    """left with the version of history valid at an instant: [valid_from, valid_to), the earliest if several overlap.

    One sort of both sides by key and instant, no range join. Versions that overlap form a run; a row looks at those of
    its run that have begun, one in a history without overlaps. Without a version the columns of history are null (how
    "inner": the row is absent); a null key or instant has none, and a version that begins at no known instant is never valid.
    """
    values = [c for c in history.columns if c not in (*key, "valid_from", "valid_to")]
    held = history.filter("valid_to IS NULL OR valid_to > valid_from").dropna(subset=[*key, "valid_from"])
    versions = held.select(*key, F.col("valid_from").alias("_at"), F.lit(0).alias("_o"), F.struct("valid_from", "valid_to", *values).alias("_v"))
    both = left.select(*key, F.col(at).alias("_at"), F.lit(1).alias("_o"), F.struct("*").alias("_l")).unionByName(versions, allowMissingColumns=True)
    order = ["_at", "_o", "_v"]
    end = F.when(F.col("_v").isNotNull(), F.coalesce("_v.valid_to", F.lit("9999-12-31").cast("timestamp")))
    reach = F.max(end).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("_v").isNotNull() & F.coalesce(F.col("_at") >= reach, F.lit(True)), 1).otherwise(0)
    runs = both.withColumn("_b", begins).withColumn("_run", F.sum("_b").over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    begun = F.collect_list("_v").over(Window.partitionBy(*key, "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = runs.withColumn("_c", begun).filter("_o = 1")
    rows = rows.withColumn("_f", F.get(F.filter("_c", lambda v: v["valid_to"].isNull() | (F.col("_at") < v["valid_to"])), F.lit(0)))
    out = rows.select("_l.*", *[F.col(f"_f.{c}").alias(c) for c in ("valid_from", "valid_to", *values)])
    return out if how == "left" else out.filter("valid_from IS NOT NULL")


def settle_hour(intervals: DataFrame) -> DataFrame:
    """intervals: newest revision of each window (meter_id, interval_start_ms, energy_wh, revision, idle: the partitions idle then)."""
    return intervals.groupBy("meter_id", floor_to(F.col("interval_start_ms"), HOUR).alias("hour_ms")).agg(
        F.sum("energy_wh").alias("energy_wh"), F.count(F.lit(1)).alias("intervals"), F.max("revision").alias("revision"), F.bool_or(F.size("idle") > 0).alias("with_idle"), (F.count(F.lit(1)) == 4).alias("is_complete")
    )


def settle_group(hours: DataFrame, groups: DataFrame) -> DataFrame:
    """hours by (group_id, hour): energy, meters and which of them are incomplete. groups: meter_id, group_id."""
    g = hours.join(groups, "meter_id").groupBy("group_id", "hour_ms")
    lacking = F.array_sort(F.collect_list(F.when(~F.col("is_complete"), F.col("meter_id"))))
    return g.agg(F.sum("energy_wh").alias("energy_wh"), F.count(F.lit(1)).alias("meters"), F.array_join(lacking, ",").alias("incomplete_meters"), F.bool_or("with_idle").alias("with_idle"))


def settle_group_chained(hours: DataFrame, assignments: DataFrame, customers: DataFrame) -> DataFrame:
    """hours by the group of the customer who had the meter in that hour, each as of the hour's start.

    assignments: meter_id, customer_id, valid_from, valid_to; customers: customer_id, group_id, valid_from, valid_to.
    """
    owned = as_of(hours.withColumn("_hour", F.timestamp_millis("hour_ms")), assignments, ["meter_id"], "_hour").drop("valid_from", "valid_to")
    placed = as_of(owned, customers, ["customer_id"], "_hour").filter("group_id IS NOT NULL")
    lacking = F.array_sort(F.collect_list(F.when(~F.col("is_complete"), F.col("meter_id"))))
    return placed.groupBy("group_id", "hour_ms").agg(F.sum("energy_wh").alias("energy_wh"), F.count(F.lit(1)).alias("meters"), F.array_join(lacking, ",").alias("incomplete_meters"), F.bool_or("with_idle").alias("with_idle"))


def settle_priced(intervals: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Cost in whole cents by meter and hour at the tariff of each interval; unpriced intervals are absent."""
    priced = as_of(intervals.withColumn("_start", F.timestamp_millis("interval_start_ms")), tariffs, ["meter_id"], "_start", "inner")
    return priced.groupBy("meter_id", floor_to(F.col("interval_start_ms"), HOUR).alias("hour_ms")).agg(
        F.sum("energy_wh").alias("energy_wh"), F.countDistinct("tariff").alias("tariffs_applied"), F.call_function("div", F.sum(F.col("energy_wh") * F.col("price")), F.lit(1000)).alias("cost_cents")
    )


def reconciliation(hours: DataFrame, groups: DataFrame) -> DataFrame:
    """Energy in hours, in groups and in meters without a group; unaccounted is what remains."""
    known = groups.select("meter_id").distinct()
    a = hours.agg(F.sum("energy_wh").alias("total_wh"))
    b = hours.join(known, "meter_id", "left_semi").agg(F.coalesce(F.sum("energy_wh"), F.lit(0)).alias("grouped_wh"))
    c = hours.join(known, "meter_id", "left_anti").agg(F.coalesce(F.sum("energy_wh"), F.lit(0)).alias("unattributed_wh"))
    return a.crossJoin(b).crossJoin(c).withColumn("unaccounted_wh", F.expr("total_wh - grouped_wh - unattributed_wh"))


def hour_lineage(intervals: DataFrame) -> DataFrame:
    """The lineage of each settled hour, from that of its intervals."""
    hour = F.expr(f"interval_start_ms div {HOUR} * {HOUR}")
    g = intervals.groupBy("meter_id", hour.alias("hour_ms")).agg(F.collect_set("lineage_id").alias("_p"))
    return g.select("meter_id", "hour_ms", derived("hour", F.concat_ws("|", "meter_id", to_iso(F.col("hour_ms"))), F.col("_p")).alias("lineage_id"))


def settlement_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Hours in both that changed; a new hour is no restatement."""
    a, b = before.select("meter_id", "hour_ms", F.col("energy_wh").alias("before_wh")), after.select("meter_id", "hour_ms", F.col("energy_wh").alias("after_wh"))
    return a.join(b, ["meter_id", "hour_ms"]).filter("before_wh <> after_wh").withColumn("delta_wh", F.expr("after_wh - before_wh"))


def history_problems(history: DataFrame, key: str) -> DataFrame:
    """Versions that end before they begin, overlap the next one, or are one of several open."""
    w = Window.partitionBy(key).orderBy("valid_from")
    h = history.withColumns({"_next": F.lead("valid_from").over(w), "_open": F.count_if(F.col("valid_to").isNull()).over(Window.partitionBy(key))})
    kinds = F.array_compact(
        F.array(
            F.when(F.col("valid_to") <= F.col("valid_from"), "backwards"),
            F.when(F.col("_next").isNotNull() & (F.col("valid_to").isNull() | (F.col("_next") < F.col("valid_to"))), "overlapping"),
            F.when(F.col("valid_to").isNull() & (F.col("_open") > 1), "multiple_open"),
        )
    )
    return h.select(key, "valid_from", F.explode(kinds).alias("problem"))
