"""First publication and numbered restatement of fifteen-minute windows.

A window is published at the first tick, not before its first reading's, at which the
status may close windows and the event clock has passed its end. What comes later
restates: only the winner is remembered, so later ticks fold over it in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.scalars import lineage_of_reading, lineage_of_result
from tidegrid.functions.timeutil import DAY, HOUR, INTERVAL, MINUTE
from tidegrid.operators.dedup import KEY, collapsed
from tidegrid.operators.running import running
from tidegrid.operators.timeline import MAY_CLOSE
from tidegrid.sources.staging import staged

ALLOWED_LATENESS = 4 * DAY
TICK = "ingest_ms div 1000 * 1000"


def _next_tick(spans: DataFrame, closing: DataFrame) -> DataFrame:
    """For each span (end_ms, from_ms) the first closing tick from from_ms on whose clock has reached end_ms, as c.

    It nearly always comes within a minute. What is missed looks on within its hour, its day, and then for the first later day
    whose highest clock will do, so a span meets few ticks, and days rather than ticks where the clock had fallen back for long.
    """
    found, left = None, spans
    for size in (MINUTE, HOUR, DAY):
        near = left.withColumn("b", F.explode(F.array(F.expr(f"from_ms div {size}"), F.expr(f"from_ms div {size} + 1"))))
        hit = near.join(closing.withColumn("b", F.expr(f"at_ms div {size}")), "b").filter("at_ms >= from_ms AND clock_ms >= end_ms")
        hit = hit.groupBy("end_ms", "from_ms").agg(F.min(F.struct("at_ms", "clock_ms", "status", "idle")).alias("c"))
        found = hit if found is None else found.unionByName(hit)
        left = left.join(hit, ["end_ms", "from_ms"], "left_anti")
    days = closing.groupBy(F.expr(f"at_ms div {DAY}").alias("day")).agg(F.max("clock_ms").alias("high"))
    day = left.join(days, F.expr(f"day > from_ms div {DAY} + 1 AND high >= end_ms")).groupBy("end_ms", "from_ms").agg(F.min("day").alias("day"))
    hit = day.join(closing.withColumn("day", F.expr(f"at_ms div {DAY}")), "day").filter("clock_ms >= end_ms").groupBy("end_ms", "from_ms").agg(F.min(F.struct("at_ms", "clock_ms", "status", "idle")).alias("c"))
    return found.unionByName(hit)


def close_ticks(readings: DataFrame, timeline: DataFrame) -> DataFrame:
    """close_ms, closed_at (the clock then), status and idle of every key that is ever published.

    The clock can fall back when an idle partition returns, so the tick from which on a key is looked at
    is followed to the next that closes.
    """
    first = readings.groupBy(*KEY).agg(F.min(F.expr(TICK)).alias("first_ms")).withColumn("end_ms", F.col("interval_start_ms") + INTERVAL)
    closing = timeline.filter(F.col("status").isin(*MAY_CLOSE)).select("at_ms", "clock_ms", "status", "idle")
    # Each tick opens the interval ends between the highest that the clock had passed and the one it has passed now.
    passed = running(closing.select("at_ms", F.expr(f"clock_ms - pmod(clock_ms, {INTERVAL})").alias("e")), "at_ms", {"high": ("max", F.col("e"))})
    passed = running(passed, "at_ms", {"before": ("lag", F.col("high"))})
    opened = passed.filter("e > before").select(F.explode(F.expr(f"sequence(before + {INTERVAL}, e, {INTERVAL})")).alias("end_ms"), F.col("at_ms").alias("open_ms"))
    start = passed.filter("before IS NULL").select(F.col("e").alias("e0"), F.col("at_ms").alias("at0"))  # one row: the first closing tick
    keyed = first.join(opened, "end_ms", "left").join(F.broadcast(start), F.col("end_ms") <= F.col("e0"), "left").withColumn("open_ms", F.coalesce("at0", "open_ms"))
    keyed = staged(keyed.filter("open_ms IS NOT NULL").withColumn("from_ms", F.greatest("first_ms", "open_ms")))
    found = _next_tick(keyed.select("end_ms", "from_ms").distinct(), closing)
    return staged(keyed.join(found, ["end_ms", "from_ms"]).select(*KEY, F.col("c.at_ms").alias("close_ms"), F.col("c.clock_ms").alias("closed_at"), F.col("c.status").alias("status"), F.col("c.idle").alias("idle")))


def published(readings: DataFrame, closes: DataFrame) -> DataFrame:
    """Revision 0 of every window: the collapse of what had arrived by its closing tick."""
    bag = readings.join(closes.select(*KEY, "close_ms", "closed_at"), KEY).filter(f"{TICK} <= close_ms")
    return collapsed(bag, [*KEY, "close_ms", "closed_at"]).withColumn("revision", F.lit(0))


def late(readings: DataFrame, closes: DataFrame) -> DataFrame:
    """Readings after their window's publication, with too_late where they exceed the allowed lateness.

    A first reading of a window that was never published is never late.
    """
    after = readings.join(closes.select(*KEY, "close_ms", "closed_at"), KEY).filter(f"{TICK} > close_ms")
    return after.withColumn("too_late", F.col("ingest_ms") - (F.col("interval_start_ms") + INTERVAL) > ALLOWED_LATENESS)


#: What came of a step, and all that a published window is remembered by: its winner and what has been counted so far.
OUTCOME = (
    "struct<at_ms:bigint,kind:string,supersedes:bigint,n:bigint,sources:string,winner:struct<ingest_ms:bigint,payload_hash:string,energy_wh:bigint>,"
    "readings:bigint,duplicates:bigint,corrections:bigint,revision:int,closed_at:bigint,parents:array<string>>"
)


def steps(admitted: DataFrame) -> DataFrame:
    """admitted readings with step_ms, the tick at which they count, as one row for each key and step.

    entries: the earliest delivery of each payload; n: readings; sources, and ids: the lineage of each reading.
    """
    order = F.struct("ingest_ms", "event_ms", "firmware", "source")
    one = lineage_of_reading(F.col("meter_id"), F.col("interval_start_ms"), F.col("payload_hash"), F.col("ingest_ms"), F.col("source"))
    reps = admitted.withColumn("_id", one).groupBy(*KEY, "step_ms", "payload_hash").agg(
        F.min_by(F.struct("ingest_ms", "energy_wh"), order).alias("r"), F.count(F.lit(1)).alias("n"), F.collect_set("source").alias("sources"), F.collect_set("_id").alias("ids")
    )
    entry = F.struct(F.col("r.ingest_ms").alias("ingest_ms"), F.col("payload_hash").alias("payload_hash"), F.col("r.energy_wh").alias("energy_wh"))
    return reps.groupBy(*KEY, "step_ms").agg(
        F.collect_list(entry).alias("entries"), F.sum("n").alias("n"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))), ", ").alias("sources"), F.flatten(F.collect_list("ids")).alias("ids")
    )


def _outcome(at, kind, supersedes, n, sources, winner, readings, duplicates, corrections, revision, closed_at, parents) -> Column:
    names = ["at_ms", "kind", "supersedes", "n", "sources", "winner", "readings", "duplicates", "corrections", "revision", "closed_at", "parents"]
    return F.struct(*[c.alias(name) for name, c in zip(names, (at, kind, supersedes, n, sources, winner, readings, duplicates, corrections, revision, closed_at, parents), strict=True)]).cast(OUTCOME)


def _first(x: Column, closed_at: Column) -> Column:
    """The outcome of a window's first step."""
    distinct = F.size(x["entries"]).cast("long")
    return _outcome(x["step_ms"], F.lit("published"), F.lit(None), x["n"], x["sources"], F.array_max(x["entries"]), x["n"], x["n"] - distinct, distinct - 1, F.lit(0), closed_at, F.array_distinct(x["ids"]))


def _next(s: Column, x: Column) -> Column:
    """The outcome of a step x after outcome s: the winner of what is remembered and what has come."""
    others = F.filter(x["entries"], lambda e: e["payload_hash"] != s["winner"]["payload_hash"])
    best = F.array_max(F.concat(others, F.array(s["winner"])))  # a retry of the winner has the winner's first delivery
    distinct = (F.size(others) + 1).cast("long")
    changed = best["energy_wh"] != s["winner"]["energy_wh"]
    return _outcome(
        x["step_ms"], F.when(changed, "restated").otherwise("confirmed"), F.when(changed, s["winner"]["energy_wh"]), x["n"], x["sources"], best, s["readings"] + x["n"],
        s["duplicates"] + F.least(x["n"] + 1 - distinct, x["n"]), s["corrections"] + distinct - 1, s["revision"] + changed.cast("int"), s["closed_at"], F.array_union(s["parents"], x["ids"]),
    )


def folded(steps: DataFrame) -> DataFrame:
    """Every outcome of the steps of each key, in order, as o; the first step publishes unless remembered has the last outcome before.

    steps: a key's rows, closed_at, remembered (an OUTCOME; null for a window that wasn't published before).
    """
    grouped = steps.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("step_ms", "entries", "n", "sources", "ids"))).alias("x"), F.first("closed_at").alias("closed_at"), F.first("remembered").alias("s")
    )
    old = F.col("s").isNotNull()
    start = F.coalesce("s", _first(F.col("x")[0], F.col("closed_at")))
    rest = F.when(old, F.col("x")).otherwise(F.expr("slice(x, 2, size(x))"))
    # The outcomes so far; the last is what the next step goes on from.
    walk = F.aggregate(rest, F.array(start), lambda out, x: F.concat(out, F.array(_next(F.element_at(out, -1), x))))
    grouped = grouped.select(*KEY, old.alias("old"), walk.alias("walk"))
    return grouped.select(*KEY, F.explode(F.when(F.col("old"), F.expr("slice(walk, 2, size(walk))")).otherwise(F.col("walk"))).alias("o"))


def ledger_rows(outcomes: DataFrame, conditions: DataFrame) -> DataFrame:
    """Outcomes (o, see folded) as rows of the ledger, with the clock's status and idle partitions at their tick."""
    cause = F.concat(F.col("n").cast("string"), F.lit(" reading(s) arrived from "), F.col("sources"), F.lit(" after revision "), (F.col("revision") - 1).cast("string"), F.lit(" was published"))
    changed = F.col("kind") == "restated"
    rows = outcomes.select(*KEY, "o.*").join(conditions.select("at_ms", "status", "idle"), "at_ms", "left")
    rows = rows.withColumn("energy_wh", F.col("winner.energy_wh"))
    return rows.select(
        *KEY, "closed_at", "at_ms", "kind", "energy_wh", "revision", "supersedes", F.when(changed, F.col("energy_wh") - F.col("supersedes")).otherwise(F.lit(0)).alias("delta_wh"),
        F.when(changed, cause).alias("cause"), "readings", F.col("duplicates").alias("duplicates_suppressed"), F.col("corrections").alias("corrections_absorbed"), F.col("winner.ingest_ms").alias("first_seen_ms"),
        lineage_of_result(F.col("meter_id"), F.col("interval_start_ms"), F.col("revision"), F.col("parents")).alias("lineage_id"), "status", "idle",
    )


def ledger(readings: DataFrame, closes: DataFrame, timeline: DataFrame) -> DataFrame:
    """Every published, restated and confirmed row, from one pass over the admitted readings.

    A row's counters and lineage cover its window's whole history up to then; closed_at stays what it was at publication,
    status and idle are those of the row's own tick.
    """
    both = readings.join(closes.select(*KEY, "close_ms", "closed_at"), KEY).withColumn("step_ms", F.greatest(F.expr(TICK), F.col("close_ms")))
    admitted = both.filter((F.col("step_ms") == F.col("close_ms")) | (F.col("ingest_ms") - (F.col("interval_start_ms") + INTERVAL) <= ALLOWED_LATENESS))
    s = steps(admitted).join(closes.select(*KEY, "closed_at"), KEY).withColumn("remembered", F.lit(None).cast(OUTCOME))
    return ledger_rows(folded(s), timeline)


def restated(readings: DataFrame, closes: DataFrame, timeline: DataFrame) -> DataFrame:
    """restated and confirmed rows, one for each window and tick with late readings."""
    return ledger(readings, closes, timeline).filter("kind <> 'published'")


def newest(ledger: DataFrame) -> DataFrame:
    """The row that states each window's last revision: the one that made it, not what later confirmed it."""
    row = F.struct("revision", (F.col("kind") != "confirmed").cast("int"), "at_ms")
    kept = ["closed_at", "kind", "energy_wh", "revision", "idle", "lineage_id"]
    return ledger.groupBy(*KEY).agg(F.max_by(F.struct(*kept), row).alias("x")).select(*KEY, *[F.col(f"x.{c}").alias(c) for c in kept])


def restatement_records(ledger: DataFrame) -> DataFrame:
    """A row for each restatement: what it changed, why, and the lineage of both revisions."""
    stated = ledger.filter("kind <> 'confirmed'")
    w = Window.partitionBy(*KEY).orderBy("revision")
    rows = stated.withColumn("supersedes_lineage_id", F.lag("lineage_id").over(w)).filter("kind = 'restated'")
    return rows.select(*KEY, "revision", F.col("supersedes").alias("previous_energy_wh"), F.col("energy_wh").alias("new_energy_wh"), "delta_wh", "cause", "closed_at", "lineage_id", "supersedes_lineage_id")


def lineage_of_revisions(ledger: DataFrame) -> DataFrame:
    """The lineage of each revision; a later confirmation of it, which has more parents, counts."""
    return ledger.groupBy(*KEY, "revision").agg(F.max_by("lineage_id", "at_ms").alias("lineage_id"))


def outcome_lines(ledger: DataFrame, observed: DataFrame) -> DataFrame:
    """Rows of the ledger as they are written down, one line an outcome; observed: status of the clock by tick (at_ms)."""
    seen = observed.select("at_ms", F.col("status").alias("observed_status"))
    return ledger.join(seen, "at_ms", "left").select(
        "kind", F.col("meter_id").alias("meter"), F.col("interval_start_ms").alias("interval_start"), F.col("energy_wh").cast("string").alias("energy_wh"), "readings", "duplicates_suppressed", "corrections_absorbed",
        "closed_at", F.col("first_seen_ms").alias("first_seen_at"), "revision", "supersedes", F.col("cause").alias("restatement_cause"), F.col("status").alias("clock_status"), F.col("idle").alias("idle_partitions"), "lineage_id", "observed_status",
    )


def open_windows(readings: DataFrame, closes: DataFrame) -> DataFrame:
    """Keys with readings that were never published."""
    return readings.select(*KEY).distinct().join(closes, KEY, "left_anti")
