"""The event clock at every tick, from observed event times alone.

A tick is a second of ingestion with accepted readings. Each partition's highest event time
so far is a running maximum; the clock is the least of those not idle, less the allowed
disorder. Nothing recurses, since a status depends on the previous tick's clock and leader but
never on its status; running values go by days, so no task walks all ticks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.timeutil import HOUR, MINUTE
from tidegrid.operators.running import running
from tidegrid.sources.staging import staged

OUT_OF_ORDER, IDLE_AFTER, STALL_AFTER, SILENT_AFTER = 2 * MINUTE, HOUR, 30 * MINUTE, 5 * MINUTE
MAY_CLOSE = ["advancing", "advancing_with_idle"]
#: Statuses that don't end by waiting.
NEEDS_HELP = ["stalled", "starved"]
#: What ticks carry from one batch to the next: each partition's highest event time, and the last tick's clock.
HEARD = "partition string, decl_ord int, h long"
LAST = "at_ms long, leader long, clock_ms long, moved_at long, arrived_at long, status string, holding_back string"


def timeline(readings: DataFrame, partitions: DataFrame, ticks: DataFrame | None = None, heard: DataFrame | None = None, last: DataFrame | None = None) -> DataFrame:
    """One row a tick: at_ms, status, clock_ms, holding_back, idle, lag_ms, leader_ms, arrivals.

    readings: partition, event_ms, ingest_ms; partitions: partition, decl_ord (declared, few); one that speaks undeclared
    counts from then on, after the declared. ticks: at_ms, where ticks without accepted readings count too (else those with
    readings). heard (HEARD) and last (LAST, one row at most) go on from where an earlier batch of ticks ended.
    """
    return clocked(readings, partitions, ticks, heard, last).drop("moved_at", "arrived_at", "leader", "p")


def clocked(readings: DataFrame, partitions: DataFrame, ticks: DataFrame | None = None, heard: DataFrame | None = None, last: DataFrame | None = None) -> DataFrame:
    """timeline with what the next batch needs: leader, moved_at, arrived_at and p (each partition's highest event time)."""
    tick = F.expr("ingest_ms div 1000 * 1000").alias("at_ms")
    per = staged(readings.groupBy(tick, "partition").agg(F.max("event_ms").alias("m"), F.count(F.lit(1)).alias("n")))
    ticks = (ticks if ticks is not None else per).select("at_ms").distinct()
    known = partitions.select("partition", "decl_ord", F.lit(None).cast("long").alias("h")) if heard is None else heard.select("partition", "decl_ord", "h").unionByName(
        partitions.join(heard, "partition", "left_anti").select("partition", "decl_ord", F.lit(None).cast("long").alias("h"))
    )
    # Undeclared ones stand behind every declared one, by name; before they speak they are nowhere.
    strangers = per.select("partition").distinct().join(known, "partition", "left_anti").select("partition", F.lit(None).cast("int").alias("decl_ord"), F.lit(None).cast("long").alias("h"))
    all_ = known.unionByName(strangers).withColumnRenamed("h", "h0")
    series = ticks.crossJoin(all_).join(per, ["at_ms", "partition"], "left")  # a row for each tick and partition, of which there are few
    series = running(series, "at_ms", {"hm": ("max", F.col("m"))}, ("partition",)).withColumn("h", F.greatest("hm", "h0"))
    series = series.filter("decl_ord IS NOT NULL OR h IS NOT NULL")
    place = F.struct(F.col("decl_ord").isNull().alias("late"), "decl_ord", "partition", "h")
    lead = ticks.join(
        series.groupBy("at_ms").agg(F.max("h").alias("leader"), F.sum(F.coalesce("n", F.lit(0))).alias("arrivals"), F.array_sort(F.collect_list(place)).alias("p")), "at_ms", "left"
    ).withColumn("arrivals", F.coalesce("arrivals", F.lit(0).cast("long"))).withColumn("p", F.coalesce("p", F.expr("cast(array() as array<struct<late:boolean,decl_ord:int,partition:string,h:bigint>>)")))
    lead = lead.withColumn("live", F.expr(f"filter(p, x -> x.h is not null and leader - x.h <= {IDLE_AFTER})"))
    lead = lead.withColumn("idle", F.expr(f"transform(filter(p, x -> x.h is null or leader - x.h > {IDLE_AFTER}), x -> x.partition)"))
    lead = staged(lead.withColumn("least", F.expr("array_min(transform(live, x -> struct(x.h, x.late, x.decl_ord, x.partition)))")))

    # The tick before the first of this batch is the last one of the batch before.
    one = last if last is not None else lead.sparkSession.createDataFrame([], LAST)
    seed = lead.agg(F.min("at_ms").alias("first_ms")).join(one.select(*[F.col(c).alias(f"l_{c}") for c in ("at_ms", "leader", "clock_ms", "moved_at", "arrived_at")]), F.lit(True), "left")
    t = running(lead, "at_ms", {"before": ("lag", F.struct("leader", "at_ms"))}).join(F.broadcast(seed), F.lit(True))
    t = t.withColumns({"is_first": F.col("at_ms") == F.col("first_ms"), "leader_before": F.coalesce("before.leader", "l_leader")})
    fresh = F.col("is_first") & F.col("l_at_ms").isNull()
    moved = fresh | (F.col("leader") > F.col("leader_before")) | (F.col("leader_before").isNull() & F.col("leader").isNotNull())
    t = running(t, "at_ms", {
        "moved_at": ("last", F.coalesce(F.when(moved, F.col("at_ms")), F.when(F.col("is_first"), F.col("l_moved_at")))),
        "arrived_at": ("last", F.coalesce(F.when((F.col("arrivals") > 0) | fresh, F.col("at_ms")), F.when(F.col("is_first"), F.col("l_arrived_at")))),
    })
    silent = F.col("at_ms") - F.col("arrived_at") > SILENT_AFTER
    base = (
        F.when(silent & (F.size("p") > 0), "starved")
        .when(F.size("p") == 0, "unstarted")
        .when(F.col("leader").isNull() | (F.size("live") == 0), "starved")
        .when((F.col("arrivals") > 0) & (F.col("at_ms") - F.col("moved_at") > STALL_AFTER), "stalled")
        .when(F.size("idle") > 0, "advancing_with_idle")
        .otherwise("advancing")
    )
    t = t.withColumn("base", base).withColumn("none", F.col("base").isin("starved", "unstarted")).withColumn("clock_ms", F.when(~F.col("none"), F.col("least.h") - OUT_OF_ORDER))
    t = running(t, "at_ms", {"was": ("lag", F.struct("clock_ms"))})
    clock_before = F.when(F.col("is_first"), F.col("l_clock_ms")).otherwise(F.col("was.clock_ms"))
    stuck = (F.col("clock_ms") <= clock_before) & (F.col("leader") > F.col("leader_before"))
    done = t.select(
        "at_ms",
        F.when((F.col("base") == "advancing") & stuck, "held_back").otherwise(F.col("base")).alias("status"),
        "clock_ms",
        F.when(~F.col("none"), F.col("least.partition")).alias("holding_back"),
        F.when(F.col("none"), F.expr("transform(p, x -> x.partition)")).otherwise(F.col("idle")).alias("idle"),
        F.when(F.col("none"), F.lit(0)).otherwise(F.col("leader") - F.col("clock_ms")).alias("lag_ms"),
        F.col("leader").alias("leader_ms"),
        "arrivals", "leader", "moved_at", "arrived_at", "p",
    )
    return staged(done)  # what uses it asks for it many times over


def may_close(end_ms) -> "F.Column":
    """Whether a window that ends at end_ms may be published at a tick of the timeline."""
    return F.col("status").isin(*MAY_CLOSE) & F.coalesce(F.col("clock_ms") >= end_ms, F.lit(False))


def will_resolve_itself(status) -> "F.Column":
    return ~status.isin(*NEEDS_HELP)


def transitions(timeline: DataFrame, last: DataFrame | None = None) -> DataFrame:
    """Ticks whose status or culprit differs from the tick before; last (LAST) is the tick before the first."""
    one = last if last is not None else timeline.sparkSession.createDataFrame([], LAST)
    seed = timeline.agg(F.min("at_ms").alias("_first")).join(one.select(F.struct("status", "holding_back").alias("_l")), F.lit(True), "left")
    t = running(timeline, "at_ms", {"_was": ("lag", F.struct("status", "holding_back"))}).join(F.broadcast(seed), F.lit(True))
    was = F.when(F.col("at_ms") == F.col("_first"), F.col("_l")).otherwise(F.col("_was"))
    return t.filter(was.isNull() | ~F.col("status").eqNullSafe(was["status"]) | ~F.col("holding_back").eqNullSafe(was["holding_back"])).select(*timeline.columns)


def condition_lines(timeline: DataFrame, last: DataFrame | None = None) -> DataFrame:
    """Lines of kind clock, where its condition changes."""
    t = transitions(timeline, last)
    return t.select(F.lit("clock").alias("kind"), "status", "holding_back", F.col("idle").alias("idle_partitions"), F.col("lag_ms").alias("lag_millis"), F.col("clock_ms").alias("clock"), F.col("status").isin(*MAY_CLOSE).alias("may_close_windows"), F.col("at_ms").alias("at"))


def condition(timeline: DataFrame) -> DataFrame:
    """The clock's last condition: one row, unstarted where nothing was observed."""
    x = timeline.agg(F.max_by(F.struct("status", "clock_ms", "holding_back"), "at_ms").alias("x"))
    return x.select(F.coalesce("x.status", F.lit("unstarted")).alias("status"), "x.clock_ms", "x.holding_back")
