"""One query for each operator family over the driver's tables, and the same in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.functions import scalars, timeutil
from tidegrid.operators import decisions, dedup, erasure, evaluation, features, normalise, policies, settlement, windows
from tidegrid.operators import timeline as ticks
from tidegrid.sources import files, tables
from tidegrid.sources.staging import shared_folder, staged

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

BASE = """
WITH e AS (SELECT event_id, user_id, 'M' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS meter_id, 'SUB-0' || CAST(user_id % 4 + 1 AS VARCHAR) AS sub,
                  epoch_us(ts) // 1000 AS event_ms, CAST(floor(value * 100) AS BIGINT) AS wh FROM events),
d AS (SELECT event_id, meter_id, sub, event_ms, wh + more AS wh, event_ms + 900000 + (event_id * 7919) % 180000 + delay AS ingest_ms, source
      FROM e JOIN (VALUES (1, 0, 0, 'stream'), (10, 90000, 0, 'stream'), (25, 259200000, 7, 'batch'), (50, 432000000, 11, 'batch')) c(k, delay, more, source) ON event_id % k = 0),
rd AS (SELECT *, CASE WHEN event_id % 101 = 0 OR event_id % 79 = 0 THEN 'unknown_payload_shape' WHEN event_id % 73 = 0 THEN 'malformed_field'
        WHEN event_id % 97 = 0 AND event_id % 3 <> 0 THEN 'unknown_unit' WHEN event_id % 71 = 0 AND event_id % 83 <> 0 THEN 'precision_beyond_canonical_unit'
        WHEN event_id % 83 = 0 THEN 'implausible_value' WHEN event_id % 89 = 0 THEN 'clock_skew_future' END AS reason FROM d),
r0 AS (SELECT event_id, meter_id, sub, CASE WHEN event_id % 3 = 0 THEN event_ms // 1000 * 1000 ELSE event_ms END AS event_ms, ingest_ms, wh AS energy_wh, source,
              'fw' || CAST(event_id % 3 + 1 AS VARCHAR) AS firmware FROM rd WHERE reason IS NULL),
r1 AS (SELECT *, event_ms - event_ms % 900000 AS interval_start_ms FROM r0),
r AS (SELECT *, substr(sha256(meter_id || '|' || strftime(make_timestamp(interval_start_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') || '|' || CAST(energy_wh AS VARCHAR)), 1, 32) AS payload_hash FROM r1),
reps AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY meter_id, interval_start_ms, payload_hash ORDER BY ingest_ms, event_ms, firmware, source) AS rn,
         count(*) OVER (PARTITION BY meter_id, interval_start_ms, payload_hash) AS n FROM r) WHERE rn = 1),
c AS (SELECT meter_id, interval_start_ms, arg_max(energy_wh, (ingest_ms, payload_hash)) AS energy_wh, max(ingest_ms) AS ingest_ms, CAST(sum(n) AS BIGINT) AS readings,
      CAST(sum(n) - count(*) AS BIGINT) AS duplicates_suppressed, count(*) - 1 AS superseded FROM reps GROUP BY 1, 2)
"""

TIMELINE = """,
tk AS (SELECT DISTINCT ingest_ms // 1000 * 1000 AS at_ms FROM r),
ps AS (SELECT * FROM (VALUES ('SUB-01', 0), ('SUB-02', 1), ('SUB-03', 2), ('SUB-04', 3)) p(sub, decl_ord)),
pm AS (SELECT ingest_ms // 1000 * 1000 AS at_ms, sub, max(event_ms) AS m, count(*) AS n FROM r GROUP BY 1, 2),
hd AS (SELECT at_ms, sub, decl_ord, n, max(m) OVER (PARTITION BY sub ORDER BY at_ms) AS h FROM tk CROSS JOIN ps LEFT JOIN pm USING (at_ms, sub)),
ld AS (SELECT *, max(h) OVER (PARTITION BY at_ms) AS leader FROM hd),
tl0 AS (SELECT at_ms, any_value(leader) AS leader, CAST(coalesce(sum(n), 0) AS BIGINT) AS arrivals, min(h) FILTER (WHERE leader - h <= 3600000) - 120000 AS clock_ms,
        arg_min(sub, (h, decl_ord)) FILTER (WHERE leader - h <= 3600000) AS holding_back,
        coalesce(string_agg(sub, ',' ORDER BY decl_ord) FILTER (WHERE h IS NULL OR leader - h > 3600000), '') AS idle FROM ld GROUP BY at_ms),
tl1 AS (SELECT *, lag(leader) OVER w AS pl, lag(clock_ms) OVER w AS pw, row_number() OVER w = 1 AS f FROM tl0 WINDOW w AS (ORDER BY at_ms)),
tl2 AS (SELECT *, last_value(CASE WHEN f OR leader > pl THEN at_ms END IGNORE NULLS) OVER (ORDER BY at_ms) AS moved_at FROM tl1),
tl3 AS (SELECT *, CASE WHEN at_ms - moved_at > 1800000 THEN 'stalled' WHEN idle <> '' THEN 'advancing_with_idle' ELSE 'advancing' END AS base FROM tl2),
tl AS (SELECT at_ms, CASE WHEN base = 'advancing' AND clock_ms <= pw AND leader > pl THEN 'held_back' ELSE base END AS status, clock_ms, holding_back, idle,
       leader - clock_ms AS lag_ms, leader AS leader_ms, arrivals FROM tl3)
"""

PUBLISHED = """,
ks AS (SELECT meter_id, interval_start_ms, min(ingest_ms // 1000 * 1000) AS first_ms FROM r GROUP BY 1, 2),
cl AS (SELECT meter_id, interval_start_ms, min(at_ms) AS close_ms, arg_min(clock_ms, at_ms) AS closed_at FROM ks JOIN tl
       ON at_ms >= first_ms AND clock_ms >= interval_start_ms + 900000 AND status IN ('advancing', 'advancing_with_idle') GROUP BY 1, 2),
pr AS (SELECT *, row_number() OVER (PARTITION BY meter_id, interval_start_ms, payload_hash ORDER BY ingest_ms, event_ms, firmware, source) AS rn
       FROM r JOIN cl USING (meter_id, interval_start_ms) WHERE ingest_ms // 1000 * 1000 <= close_ms),
pub AS (SELECT meter_id, interval_start_ms, close_ms, closed_at, arg_max(energy_wh, (ingest_ms, payload_hash)) FILTER (WHERE rn = 1) AS energy_wh, count(*) AS readings FROM pr GROUP BY ALL)
"""

ISO = "strftime(make_timestamp({} * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')"
READING_ID = f"substr(sha256(concat_ws(chr(31), 'reading', meter_id, {ISO.format('interval_start_ms')}, payload_hash, {ISO.format('ingest_ms')}, source)), 1, 32)"
#: Every step of a published window: the readings up to its closing tick, then those of each later tick within the lateness.
LEDGER = f""",
ad AS (SELECT r.*, greatest(ingest_ms // 1000 * 1000, close_ms) AS step_ms, close_ms, closed_at, {READING_ID} AS id FROM r JOIN cl USING (meter_id, interval_start_ms)
       WHERE ingest_ms // 1000 * 1000 <= close_ms OR ingest_ms - (interval_start_ms + 900000) <= 345600000),
a1 AS (SELECT *, row_number() OVER (PARTITION BY meter_id, interval_start_ms, step_ms, payload_hash ORDER BY ingest_ms, event_ms, firmware, source) AS rn FROM ad),
sp AS (SELECT meter_id, interval_start_ms, step_ms, any_value(closed_at) AS closed_at, count(*) AS n, count(*) FILTER (rn = 1) AS k, list(payload_hash) FILTER (rn = 1) AS hs, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources,
       arg_max(payload_hash, (ingest_ms, payload_hash)) FILTER (rn = 1) AS wh, arg_max(energy_wh, (ingest_ms, payload_hash)) FILTER (rn = 1) AS energy_wh, arg_max(ingest_ms, (ingest_ms, payload_hash)) FILTER (rn = 1) AS wi FROM a1 GROUP BY 1, 2, 3),
f0 AS (SELECT *, lag(wh) OVER w AS ph, lag(energy_wh) OVER w AS pe FROM sp WINDOW w AS (PARTITION BY meter_id, interval_start_ms ORDER BY step_ms)),
f1 AS (SELECT *, coalesce(energy_wh <> pe, false) AS changed, CASE WHEN ph IS NULL OR wh <> ph THEN wi END AS si, k + CASE WHEN ph IS NULL OR list_contains(hs, ph) THEN 0 ELSE 1 END AS u FROM f0),
pa AS (SELECT f1.meter_id, f1.interval_start_ms, f1.step_ms, string_agg(DISTINCT ad.id, chr(31) ORDER BY ad.id) AS ids FROM f1 JOIN ad ON ad.meter_id = f1.meter_id AND ad.interval_start_ms = f1.interval_start_ms AND ad.step_ms <= f1.step_ms GROUP BY 1, 2, 3),
f2 AS (SELECT meter_id, interval_start_ms, step_ms AS at_ms, closed_at, CASE WHEN ph IS NULL THEN 'published' WHEN changed THEN 'restated' ELSE 'confirmed' END AS kind, energy_wh,
       CAST(sum(CAST(changed AS INTEGER)) OVER w AS INTEGER) AS revision, CASE WHEN changed THEN pe END AS supersedes, CASE WHEN changed THEN energy_wh - pe ELSE 0 END AS delta_wh, n, sources,
       CAST(sum(n) OVER w AS BIGINT) AS readings, CAST(sum(CASE WHEN ph IS NULL THEN n - k ELSE least(n, n + 1 - u) END) OVER w AS BIGINT) AS duplicates_suppressed,
       CAST(sum(CASE WHEN ph IS NULL THEN k - 1 ELSE u - 1 END) OVER w AS BIGINT) AS corrections_absorbed, last_value(si IGNORE NULLS) OVER w AS first_seen_ms, ids
       FROM f1 JOIN pa USING (meter_id, interval_start_ms, step_ms) WINDOW w AS (PARTITION BY meter_id, interval_start_ms ORDER BY step_ms)),
lg AS (SELECT f2.* EXCLUDE (n, sources, ids), status, idle, CASE WHEN kind = 'restated' THEN n || ' reading(s) arrived from ' || sources || ' after revision ' || (revision - 1) || ' was published' END AS cause,
       substr(sha256(concat_ws(chr(31), 'window', meter_id || '|' || {ISO.format('interval_start_ms')} || '|r' || revision, ids)), 1, 32) AS lineage_id FROM f2 JOIN tl USING (at_ms)),
nw AS (SELECT * FROM lg WHERE kind <> 'confirmed' QUALIFY row_number() OVER (PARTITION BY meter_id, interval_start_ms ORDER BY revision DESC) = 1),
h AS (SELECT meter_id, interval_start_ms // 3600000 * 3600000 AS hour_ms, CAST(sum(energy_wh) AS BIGINT) AS energy_wh, count(*) AS intervals, max(revision) AS revision, bool_or(idle <> '') AS with_idle, count(*) = 4 AS is_complete FROM nw GROUP BY 1, 2)
"""

TARIFFS = """,
od AS (SELECT o_custkey, CAST(o_orderdate AS TIMESTAMP) AS valid_from, max(o_orderkey) AS tariff FROM orders GROUP BY 1, 2),
tf AS (SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS valid_to, tariff % 30 + 10 AS price FROM od)
"""


DAY_SQL = BASE + TIMELINE + PUBLISHED + LEDGER


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def readings(spark: SparkSession, d: str) -> DataFrame:
    return normalise.readings(tables.arrivals(spark, d))


def observed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    r = staged(readings(spark, d))
    return r, ticks.timeline(r, tables.partitions(spark))


def closed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Readings, the closing tick of every window that is published, and the timeline."""
    r, t = observed(spark, d)
    return r, windows.close_ticks(r, t), t


def ledger(spark: SparkSession, d: str) -> DataFrame:
    return windows.ledger(*closed(spark, d))


def intervals(spark: SparkSession, d: str) -> DataFrame:
    """What the ledger last stated of each published window."""
    return windows.newest(ledger(spark, d))


def hours(spark: SparkSession, d: str) -> DataFrame:
    return settlement.settle_hour(intervals(spark, d))


def groups(spark: SparkSession, d: str) -> DataFrame:
    """A balancing group for the meters of two in three users."""
    return tables.events(spark, d).select("meter_id", "user_id").distinct().filter("user_id % 3 <> 0").select("meter_id", F.concat(F.lit("G"), (F.col("user_id") % 7).cast("string")).alias("group_id"))


@query(DAY_SQL + "SELECT * FROM h")
def settle_hour(spark, d):
    return hours(spark, d)


@query(BASE + "SELECT count(*) AS n, CAST(sum(energy_wh) AS BIGINT) AS energy_wh, min(event_ms) AS first_ms, max(event_ms) AS last_ms, firmware FROM r GROUP BY firmware")
def normalise_accept(spark, d):
    return readings(spark, d).groupBy("firmware").agg(F.count(F.lit(1)).alias("n"), F.sum("energy_wh").alias("energy_wh"), F.min("event_ms").alias("first_ms"), F.max("event_ms").alias("last_ms"))


@query(BASE + "SELECT reason, source_ AS source, count(*) AS n FROM (SELECT reason, CASE WHEN event_id % 101 = 0 THEN 'radio' ELSE source END AS source_ FROM rd WHERE reason IS NOT NULL) GROUP BY ALL")
def normalise_quarantine(spark, d):
    return normalise.quarantine(tables.arrivals(spark, d)).groupBy("reason", "source").agg(F.count(F.lit(1)).alias("n"))


@query(BASE + "SELECT event_id, ingest_ms, payload_hash, substr(sha256(concat_ws(chr(31), 'reading', meter_id, strftime(make_timestamp(interval_start_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ'), payload_hash, strftime(make_timestamp(ingest_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ'), source)), 1, 32) AS lineage_id FROM r")
def lineage_reading(spark, d):
    r = readings(spark, d)
    return r.select("event_id", "ingest_ms", "payload_hash", scalars.lineage_of_reading(F.col("meter_id"), F.col("interval_start_ms"), F.col("payload_hash"), F.col("ingest_ms"), F.col("source")).alias("lineage_id"))


@query(
    BASE
    + """, lr AS (SELECT meter_id, interval_start_ms, substr(sha256(concat_ws(chr(31), 'reading', meter_id, strftime(make_timestamp(interval_start_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ'), payload_hash, strftime(make_timestamp(ingest_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ'), source)), 1, 32) AS id FROM r)
SELECT meter_id, interval_start_ms, substr(sha256(concat_ws(chr(31), 'window', meter_id || '|' || strftime(make_timestamp(interval_start_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') || '|r0', string_agg(DISTINCT id, chr(31) ORDER BY id))), 1, 32) AS lineage_id FROM lr GROUP BY meter_id, interval_start_ms"""
)
def lineage_result(spark, d):
    r = readings(spark, d)
    one = scalars.lineage_of_reading(F.col("meter_id"), F.col("interval_start_ms"), F.col("payload_hash"), F.col("ingest_ms"), F.col("source"))
    g = r.groupBy("meter_id", "interval_start_ms").agg(F.collect_set(one).alias("p"))
    return g.select("meter_id", "interval_start_ms", scalars.lineage_of_result(F.col("meter_id"), F.col("interval_start_ms"), F.lit(0), F.col("p")).alias("lineage_id"))


@query(BASE + "SELECT * FROM c")
def dedup_collapse(spark, d):
    return dedup.collapsed(readings(spark, d)).select("meter_id", "interval_start_ms", "energy_wh", "ingest_ms", "readings", "duplicates_suppressed", F.size("superseded").cast("long").alias("superseded"))


@query(BASE + TIMELINE + "SELECT * FROM tl")
def clock_timeline(spark, d):
    return observed(spark, d)[1].withColumn("idle", F.array_join("idle", ","))


@query(BASE + TIMELINE + "SELECT status, count(*) AS n FROM (SELECT *, lag(status) OVER w AS s, lag(holding_back) OVER w AS b, row_number() OVER w AS k FROM tl WINDOW w AS (ORDER BY at_ms)) WHERE k = 1 OR status IS DISTINCT FROM s OR holding_back IS DISTINCT FROM b GROUP BY status")
def clock_transitions(spark, d):
    return ticks.transitions(observed(spark, d)[1]).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(BASE + TIMELINE + PUBLISHED + "SELECT * FROM pub")
def windows_published(spark, d):
    return windows.published(*closed(spark, d)[:2]).select("meter_id", "interval_start_ms", "close_ms", "closed_at", "energy_wh", "readings")


@query(BASE + TIMELINE + PUBLISHED + "SELECT source, ingest_ms - (interval_start_ms + 900000) > 345600000 AS too_late, count(*) AS n FROM r JOIN cl USING (meter_id, interval_start_ms) WHERE ingest_ms // 1000 * 1000 > close_ms GROUP BY ALL")
def too_late_for_window(spark, d):
    return windows.late(*closed(spark, d)[:2]).groupBy("source", "too_late").agg(F.count(F.lit(1)).alias("n"))


@query(DAY_SQL + "SELECT meter_id, interval_start_ms, at_ms, kind, energy_wh, revision, delta_wh, cause FROM lg WHERE kind <> 'published'")
def windows_restated(spark, d):
    return windows.restated(*closed(spark, d)).select("meter_id", "interval_start_ms", "at_ms", "kind", "energy_wh", "revision", "delta_wh", "cause")


@query(DAY_SQL + "SELECT meter_id, interval_start_ms, closed_at, kind, energy_wh, revision, idle, lineage_id FROM nw")
def ledger_newest(spark, d):
    return intervals(spark, d).withColumn("idle", F.array_join("idle", ","))


@query(DAY_SQL + "SELECT kind, count(*) AS n, CAST(sum(delta_wh) AS BIGINT) AS net_wh FROM lg GROUP BY 1")
def restatement_totals(spark, d):
    return ledger(spark, d).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("delta_wh").alias("net_wh"))


@query(DAY_SQL + """SELECT kind, meter_id AS meter, interval_start_ms AS interval_start, CAST(energy_wh AS VARCHAR) AS energy_wh, readings, duplicates_suppressed, corrections_absorbed, closed_at, first_seen_ms AS first_seen_at, revision,
supersedes, cause AS restatement_cause, status AS clock_status, idle AS idle_partitions, lineage_id, status AS observed_status FROM lg""")
def evidence_lines(spark, d):
    r, closes, t = closed(spark, d)
    return windows.outcome_lines(windows.ledger(r, closes, t), t).withColumn("idle_partitions", F.array_join("idle_partitions", ","))


@query(DAY_SQL + """SELECT n.meter_id, n.interval_start_ms, n.revision, n.supersedes AS previous_energy_wh, n.energy_wh AS new_energy_wh, n.delta_wh, n.cause, n.closed_at, n.lineage_id, o.lineage_id AS supersedes_lineage_id
FROM lg n JOIN lg o ON n.meter_id = o.meter_id AND n.interval_start_ms = o.interval_start_ms AND o.revision = n.revision - 1 AND o.kind <> 'confirmed' WHERE n.kind = 'restated'""")
def restatement_records(spark, d):
    return windows.restatement_records(ledger(spark, d))


@query(DAY_SQL + "SELECT meter_id, interval_start_ms, revision, arg_max(lineage_id, at_ms) AS lineage_id FROM lg GROUP BY 1, 2, 3")
def lineage_revisions(spark, d):
    return windows.lineage_of_revisions(ledger(spark, d))


@query(DAY_SQL + "SELECT revision, count(*) AS n FROM nw GROUP BY 1")
def revisions_histogram(spark, d):
    return intervals(spark, d).groupBy("revision").agg(F.count(F.lit(1)).alias("n"))


@query(BASE + TIMELINE + PUBLISHED + "SELECT meter_id, interval_start_ms FROM r WHERE (meter_id, interval_start_ms) NOT IN (SELECT (meter_id, interval_start_ms) FROM cl) GROUP BY 1, 2")
def windows_open(spark, d):
    return windows.open_windows(*closed(spark, d)[:2])


@query(BASE + TIMELINE + """SELECT 'clock' AS kind, status, holding_back, idle AS idle_partitions, lag_ms AS lag_millis, clock_ms AS clock, status IN ('advancing', 'advancing_with_idle') AS may_close_windows, at_ms AS at
FROM (SELECT *, lag(status) OVER w AS s, lag(holding_back) OVER w AS b, row_number() OVER w AS k FROM tl WINDOW w AS (ORDER BY at_ms)) WHERE k = 1 OR status IS DISTINCT FROM s OR holding_back IS DISTINCT FROM b""")
def condition_lines(spark, d):
    return ticks.condition_lines(observed(spark, d)[1]).withColumn("idle_partitions", F.array_join("idle_partitions", ","))


@query(BASE + TIMELINE + "SELECT status, clock_ms, holding_back FROM tl ORDER BY at_ms DESC LIMIT 1")
def clock_condition(spark, d):
    return ticks.condition(observed(spark, d)[1])


@query(DAY_SQL + f"SELECT meter_id, hour_ms, substr(sha256(concat_ws(chr(31), 'hour', meter_id || '|' || {ISO.format('hour_ms')}, string_agg(lineage_id, chr(31) ORDER BY lineage_id))), 1, 32) AS lineage_id FROM (SELECT *, interval_start_ms // 3600000 * 3600000 AS hour_ms FROM nw) GROUP BY 1, 2")
def lineage_hour(spark, d):
    return settlement.hour_lineage(intervals(spark, d))


@query(
    """WITH t AS (SELECT o_orderkey AS k, CAST(o_custkey % 5 AS INTEGER) AS revision, CAST(floor(o_totalprice) AS BIGINT) AS energy_wh FROM orders WHERE o_orderkey % 2 = 0),
s AS (SELECT o_orderkey AS k, CAST(o_custkey % 7 AS INTEGER) AS revision, CAST(floor(o_totalprice) AS BIGINT) + 1 AS energy_wh FROM orders WHERE o_orderkey % 3 = 0)
SELECT coalesce(t.k, s.k) AS k, CASE WHEN t.k IS NULL OR s.revision > t.revision THEN s.revision ELSE t.revision END AS revision,
CASE WHEN t.k IS NULL OR s.revision > t.revision THEN s.energy_wh ELSE t.energy_wh END AS energy_wh FROM t FULL OUTER JOIN s ON t.k = s.k"""
)
def merge_newest_revision(spark, d):
    o = tables.table(spark, d, "orders")
    row = lambda m, more: o.select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % m).cast("int").alias("revision"), (F.floor("o_totalprice") + more).cast("long").alias("energy_wh"))
    return files.upserted(row(5, 0).filter("k % 2 = 0"), row(7, 1).filter("k % 3 = 0"), ["k"])


GROUPS = ", g AS (SELECT DISTINCT meter_id, 'G' || CAST(user_id % 7 AS VARCHAR) AS group_id FROM e WHERE user_id % 3 <> 0) "


@query(DAY_SQL + GROUPS + "SELECT group_id, hour_ms, CAST(sum(energy_wh) AS BIGINT) AS energy_wh, count(*) AS meters, coalesce(string_agg(meter_id, ',' ORDER BY meter_id) FILTER (WHERE NOT is_complete), '') AS incomplete_meters, bool_or(with_idle) AS with_idle FROM h JOIN g USING (meter_id) GROUP BY 1, 2")
def settle_group(spark, d):
    return settlement.settle_group(hours(spark, d), groups(spark, d))


#: Who has a meter changes once for each; every eleventh meter has nobody after that. Some customers change their group, every third has none.
OWNERS = """,
us AS (SELECT DISTINCT user_id, meter_id FROM e),
asg AS (SELECT meter_id, 'C' || user_id AS customer_id, 1704067200000 AS f, 1705017600000 + user_id % 7 * 86400000 AS t FROM us
        UNION ALL SELECT meter_id, 'C' || (user_id + 1), 1705017600000 + user_id % 7 * 86400000, NULL FROM us WHERE user_id % 11 <> 0),
cus AS (SELECT 'C' || k AS customer_id, 'G' || (k % 7) AS group_id, 1704067200000 AS f, CASE WHEN k % 5 = 0 THEN 1705708800000 END AS t FROM (SELECT DISTINCT user_id AS k FROM us UNION SELECT user_id + 1 FROM us) WHERE k % 3 <> 0
        UNION ALL SELECT 'C' || k, 'G' || (k % 7 + 1), 1705708800000, NULL FROM (SELECT DISTINCT user_id AS k FROM us UNION SELECT user_id + 1 FROM us) WHERE k % 3 <> 0 AND k % 5 = 0)
"""


def owners(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """assignments and customers, with the rules that OWNERS states."""
    u = tables.events(spark, d).select("user_id", "meter_id").distinct()
    change = F.lit(1_705_017_600_000) + F.col("user_id") % 7 * 86_400_000
    timed = lambda df, key: df.select(*key, F.timestamp_millis("f").alias("valid_from"), F.timestamp_millis("t").alias("valid_to"))
    name = lambda k: F.concat(F.lit("C"), k.cast("string"))
    first = u.select("meter_id", name(F.col("user_id")).alias("customer_id"), F.lit(1_704_067_200_000).alias("f"), change.alias("t"))
    second = u.filter("user_id % 11 <> 0").select("meter_id", name(F.col("user_id") + 1).alias("customer_id"), change.alias("f"), F.lit(None).cast("long").alias("t"))
    k = u.select(F.col("user_id").alias("k")).union(u.select(F.col("user_id") + 1)).distinct().filter("k % 3 <> 0")
    group = lambda more: F.concat(F.lit("G"), (F.col("k") % 7 + more).cast("string")).alias("group_id")
    move = F.lit(1_705_708_800_000)
    was = k.select(name(F.col("k")).alias("customer_id"), group(0), F.lit(1_704_067_200_000).alias("f"), F.when(F.col("k") % 5 == 0, move).alias("t"))
    then = k.filter("k % 5 = 0").select(name(F.col("k")).alias("customer_id"), group(1), move.alias("f"), F.lit(None).cast("long").alias("t"))
    return timed(first.unionByName(second), ["meter_id", "customer_id"]), timed(was.unionByName(then), ["customer_id", "group_id"])


@query(DAY_SQL + OWNERS + """SELECT group_id, hour_ms, CAST(sum(energy_wh) AS BIGINT) AS energy_wh, count(*) AS meters, coalesce(string_agg(h.meter_id, ',' ORDER BY h.meter_id) FILTER (WHERE NOT is_complete), '') AS incomplete_meters, bool_or(with_idle) AS with_idle
FROM h JOIN asg ON asg.meter_id = h.meter_id AND hour_ms >= asg.f AND (asg.t IS NULL OR hour_ms < asg.t) JOIN cus ON cus.customer_id = asg.customer_id AND hour_ms >= cus.f AND (cus.t IS NULL OR hour_ms < cus.t) GROUP BY 1, 2""")
def settle_group_chained(spark, d):
    return settlement.settle_group_chained(hours(spark, d), *owners(spark, d))


@query(DAY_SQL + GROUPS + "SELECT CAST(sum(energy_wh) AS BIGINT) AS total_wh, CAST(sum(energy_wh) FILTER (WHERE meter_id IN (SELECT meter_id FROM g)) AS BIGINT) AS grouped_wh, CAST(sum(energy_wh) FILTER (WHERE meter_id NOT IN (SELECT meter_id FROM g)) AS BIGINT) AS unattributed_wh, CAST(0 AS BIGINT) AS unaccounted_wh FROM h")
def reconciliation(spark, d):
    return settlement.reconciliation(hours(spark, d), groups(spark, d))


@query(DAY_SQL + GROUPS + "SELECT DISTINCT meter_id FROM h WHERE meter_id NOT IN (SELECT meter_id FROM g)")
def unattributed_meters(spark, d):
    return hours(spark, d).select("meter_id").distinct().join(groups(spark, d), "meter_id", "left_anti")


@query(DAY_SQL + TARIFFS + ", t2 AS (SELECT 'M' || lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS meter_id, valid_from, valid_to, tariff, price FROM tf) SELECT nw.meter_id, interval_start_ms // 3600000 * 3600000 AS hour_ms, CAST(sum(energy_wh) AS BIGINT) AS energy_wh, count(DISTINCT tariff) AS tariffs_applied, CAST(sum(energy_wh * price) // 1000 AS BIGINT) AS cost_cents FROM nw JOIN t2 ON nw.meter_id = t2.meter_id AND make_timestamp(interval_start_ms * 1000) >= valid_from AND (valid_to IS NULL OR make_timestamp(interval_start_ms * 1000) < valid_to) GROUP BY 1, 2")
def settle_priced(spark, d):
    t = tables.tariffs(spark, d).withColumn("meter_id", F.concat(F.lit("M"), F.lpad(F.col("o_custkey").cast("string"), 5, "0"))).drop("o_custkey")
    i = intervals(spark, d)
    return settlement.settle_priced(i, t)


@query(TARIFFS.replace(",", "WITH", 1) + "SELECT l_orderkey, l_linenumber, tariff FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN tf ON tf.o_custkey = orders.o_custkey AND CAST(l_shipdate AS TIMESTAMP) >= valid_from AND (valid_to IS NULL OR CAST(l_shipdate AS TIMESTAMP) < valid_to)")
def asof_join(spark, d):
    li = tables.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("at"))
    both = li.join(tables.table(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return settlement.as_of(both, tables.tariffs(spark, d), ["o_custkey"], "at").select("l_orderkey", "l_linenumber", "tariff")


@query("""WITH o AS (SELECT o_custkey, CAST(o_orderdate AS TIMESTAMP) AS valid_from, max(o_orderkey) AS k FROM orders GROUP BY 1, 2),
v AS (SELECT o_custkey, valid_from, CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN valid_from - INTERVAL 1 DAY ELSE valid_from + INTERVAL 30 DAY END AS valid_to FROM o),
n AS (SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS nx, count(*) FILTER (WHERE valid_to IS NULL) OVER (PARTITION BY o_custkey) AS op FROM v)
SELECT o_custkey, valid_from, 'overlapping' AS problem FROM n WHERE nx IS NOT NULL AND (valid_to IS NULL OR nx < valid_to) UNION ALL SELECT o_custkey, valid_from, 'backwards' FROM n WHERE valid_to <= valid_from
UNION ALL SELECT o_custkey, valid_from, 'multiple_open' FROM n WHERE valid_to IS NULL AND op > 1""")
def scd2_problems(spark, d):
    o = tables.table(spark, d, "orders").groupBy("o_custkey", F.col("o_orderdate").cast("timestamp").alias("valid_from")).agg(F.max("o_orderkey").alias("k"))
    end = F.when(F.col("k") % 13 == 0, None).when(F.col("k") % 17 == 0, F.expr("valid_from - interval 1 day")).otherwise(F.expr("valid_from + interval 30 days"))
    return settlement.history_problems(o.withColumn("valid_to", end).drop("k"), "o_custkey")


@query(DAY_SQL + """, b AS (SELECT meter_id, interval_start_ms // 3600000 * 3600000 AS hour_ms, CAST(sum(energy_wh) AS BIGINT) AS before_wh FROM lg WHERE kind = 'published' GROUP BY 1, 2)
SELECT meter_id, hour_ms, before_wh, energy_wh AS after_wh, energy_wh - before_wh AS delta_wh FROM h JOIN b USING (meter_id, hour_ms) WHERE energy_wh <> before_wh""")
def settlement_diff(spark, d):
    """Hours as first published against hours as last stated."""
    rows = staged(ledger(spark, d))
    return settlement.settlement_diff(settlement.settle_hour(rows.filter("kind = 'published'")), settlement.settle_hour(windows.newest(rows)))


AT, SEEN, HOUR_MS = 1_705_276_800_000, 1_705_300_000_000, 43_200
FEATURE_SQL = {"sum": "sum(energy_wh)", "mean": "CAST((2 * sum(energy_wh) + count(*)) // (2 * count(*)) AS BIGINT)", "max": "max(energy_wh)", "min": "min(energy_wh)", "count": "count(*)", "last": "arg_max(energy_wh, (event_ms, ingest_ms, energy_wh))"}


def feature_rows(spark, d):
    return readings(spark, d).select(F.col("meter_id").alias("entity_id"), "event_ms", "ingest_ms", F.col("energy_wh").alias("value"))


def _feature(kind: str) -> None:
    def run(spark, d):
        return features.resolved(features.FeatureContract(f"energy_{kind}", kind, HOUR_MS, 900, 900), feature_rows(spark, d), AT, SEEN)

    run.__name__ = f"feature_asof_{kind}"
    query(BASE + f"SELECT meter_id AS entity_id, CAST({FEATURE_SQL[kind]} AS BIGINT) AS value FROM r WHERE event_ms > {AT - HOUR_MS * 1000} AND event_ms <= {AT} AND ingest_ms <= {SEEN} GROUP BY 1")(run)


for _kind in FEATURE_SQL:
    _feature(_kind)


@query(BASE + ", s AS (SELECT *, sum(energy_wh) OVER (PARTITION BY meter_id ORDER BY event_ms RANGE BETWEEN 3599999 PRECEDING AND CURRENT ROW) AS served FROM r) SELECT meter_id AS entity_id, max(event_ms) AS event_ms, CAST(arg_max(served, event_ms) AS BIGINT) AS value FROM s GROUP BY 1")
def feature_online(spark, d):
    return features.latest_served(features.FeatureContract("energy_1h", "sum", 3600, 900, 900), feature_rows(spark, d))


INSTANTS, LAG = [AT + k * 21_600_000 for k in range(8)], 3_600_000
#: What is served is spoilt for some entities, so that each kind of difference comes: one not served, one served that isn't there, one a watt hour more.
PARITY_SQL = BASE + f""", ts AS (SELECT unnest({INSTANTS}) AS at_ms),
off_ AS (SELECT meter_id AS entity_id, at_ms, CAST(sum(energy_wh) AS BIGINT) AS value FROM r JOIN ts ON event_ms > at_ms - {HOUR_MS * 1000} AND event_ms <= at_ms AND ingest_ms <= at_ms + {LAG} GROUP BY 1, 2),
onl AS (SELECT entity_id, at_ms, CASE WHEN right(entity_id, 1) = '3' THEN value + 1 ELSE value END AS value FROM off_ WHERE right(entity_id, 1) <> '1'),
of2 AS (SELECT * FROM off_ WHERE right(entity_id, 1) <> '2')
"""


@query(PARITY_SQL + """SELECT entity_id, at_ms, onl.value AS online, of2.value AS offline, CASE WHEN onl.value IS NULL THEN 'online_missing' WHEN of2.value IS NULL THEN 'offline_missing' ELSE 'value' END AS kind
FROM onl FULL JOIN of2 USING (entity_id, at_ms) WHERE onl.value IS DISTINCT FROM of2.value""")
def feature_parity(spark, d):
    """What is served at eight instants against the same resolved afterwards, with differences put in on purpose."""
    c, rows = features.FeatureContract("energy_12h", "sum", HOUR_MS, 900, 900), feature_rows(spark, d)
    online, last = features.served_at(c, rows, INSTANTS, LAG), F.right("entity_id", F.lit(1))
    online = online.filter(last != "1").withColumn("value", F.col("value") + (last == "3").cast("long"))
    return features.parity(online, features.resolved_at(c, rows, INSTANTS, LAG).filter(last != "2"), ["entity_id", "at_ms"])


@query(PARITY_SQL + "SELECT entity_id, at_ms, value FROM off_")
def feature_served_at(spark, d):
    """What is served at each instant, unspoilt: the SQL says the same by the other way."""
    return features.served_at(features.FeatureContract("energy_12h", "sum", HOUR_MS, 900, 900), feature_rows(spark, d), INSTANTS, LAG)


@query(BASE + f"SELECT meter_id AS entity_id, CAST((2 * sum(energy_wh) + count(*)) // (2 * count(*)) AS BIGINT) AS value FROM r WHERE meter_id = 'M00003' AND event_ms > {AT - 30 * 86_400_000} AND event_ms <= {AT} AND ingest_ms <= {SEEN} GROUP BY 1")
def feature_as_of_sql(spark, d):
    c = features.FeatureContract("energy_mean", "mean", 30 * 86_400, 900, 900)
    return spark.sql(features.as_of_sql(c, "{rows}"), {"entity": "M00003", "at_ms": AT, "seen_ms": SEEN}, rows=feature_rows(spark, d))


@query(BASE + f""", f AS (SELECT meter_id, max(event_ms) AS event_ms, arg_max(energy_wh, (event_ms, ingest_ms, energy_wh)) AS v FROM r WHERE ingest_ms <= {SEEN} GROUP BY 1),
q AS (SELECT meter_id, v, CASE WHEN right(meter_id, 1) = '1' THEN 'clock_stalled' WHEN right(meter_id, 1) = '2' THEN 'window_not_closed' WHEN {SEEN} - event_ms > 86400000 THEN 'feature_stale' END AS unavailable FROM f)
SELECT substr(sha256('decision|inspect|' || meter_id || '|{SEEN}'), 1, 32) AS decision_id, meter_id AS entity_id, CASE WHEN unavailable IS NULL THEN CASE WHEN v >= 500 THEN 'flag' ELSE 'pass' END WHEN right(meter_id, 1) = '2' THEN 'none' ELSE 'hold' END AS action,
CASE WHEN unavailable IS NULL THEN 'model' WHEN right(meter_id, 1) = '2' THEN 'withheld' ELSE 'fallback' END AS origin, unavailable FROM q""")
def decide(spark, d):
    rows = feature_rows(spark, d).filter(F.col("ingest_ms") <= SEEN)
    latest = rows.groupBy("entity_id").agg(F.max("event_ms").alias("event_ms"), F.max_by("value", F.struct("event_ms", "ingest_ms", "value")).alias("value"))
    last = F.right("entity_id", F.lit(1))
    status = F.when(last == "1", "stalled").when(last == "2", "held_back").otherwise("advancing")
    e = latest.withColumns({"at_ms": F.lit(SEEN), "clock_status": status})
    return decisions.decided(e, "inspect", F.col("value"), 500, F.when(last != "2", "hold"), 86_400_000).drop("at_ms")


@query("""WITH t AS (SELECT event_id, CAST(floor(value * 100) AS BIGINT) AS load_w, 400 + user_id % 100 AS limit_w FROM events), o AS (SELECT *, limit_w - load_w AS headroom_w FROM t)
SELECT event_id, headroom_w, CASE WHEN headroom_w < 0 THEN 'throttle:' || CAST(least(90, (-headroom_w * 10000 // greatest(1, limit_w)) * 5 // 100) AS VARCHAR) END AS action, CASE WHEN limit_w <= 0 THEN 10000 ELSE load_w * 10000 // limit_w END AS utilisation_bp FROM o""")
def curtail(spark, d):
    t = tables.events(spark, d).select("event_id", F.col("wh").alias("load_w"), (F.lit(400) + F.col("user_id") % 100).alias("limit_w"))
    return decisions.curtailed(t).select("event_id", "headroom_w", "action", scalars.utilisation_bp(F.col("load_w"), F.col("limit_w")).alias("utilisation_bp"))


@query(BASE + "SELECT p AS principal, m AS resource FROM (VALUES ('ops', ['energy'], ['SUB-01', 'SUB-02']), ('audit', ['energy', 'labels'], ['SUB-03'])) g(p, k, v) JOIN (SELECT DISTINCT meter_id AS m, sub FROM e) x ON list_contains(k, 'energy') AND list_contains(v, sub)")
def policy_reachable(spark, d):
    grants = spark.createDataFrame([("ops", {"kind": ["energy"], "sub": ["SUB-01", "SUB-02"]}), ("audit", {"kind": ["energy", "labels"], "sub": ["SUB-03"]})], "principal string, allowed map<string, array<string>>")
    e = tables.events(spark, d).select(F.col("meter_id").alias("resource"), "partition").distinct()
    return policies.reachable(grants, e.select("resource", F.create_map(F.lit("kind"), F.lit("energy"), F.lit("sub"), F.col("partition")).alias("tags")))


@query(BASE + "SELECT event_id, ingest_ms FROM r WHERE NOT (meter_id = 'M00007' AND event_ms >= 1704672000000 AND event_ms < 1705276800000)")
def erasure_delete(spark, d):
    r = readings(spark, d).withColumn("at", F.timestamp_millis("event_ms"))
    own = spark.createDataFrame([("M00007", "C00007", 1_704_672_000_000, 1_705_276_800_000), ("M00008", "C00008", 1_704_672_000_000, None)], "meter_id string, customer_id string, f long, t long")
    own = own.select("meter_id", "customer_id", F.timestamp_millis("f").alias("valid_from"), F.timestamp_millis("t").alias("valid_to"))
    return erasure.erased(r, own, "C00007").select("event_id", "ingest_ms")


POPULATION = "p AS (SELECT doc_id % 10 AS decile, n_chars % 1000 AS score, quality AS truly, n_chars % 1000 >= 400 AS flagged FROM documents JOIN labels USING (doc_id))"


def population(spark, d):
    both = tables.table(spark, d, "documents").join(tables.table(spark, d, "labels"), "doc_id")
    return both.select((F.col("doc_id") % 10).alias("decile"), (F.col("n_chars") % 1000).alias("score"), F.col("quality").alias("truly"), (F.col("n_chars") % 1000 >= 400).alias("flagged"))


@query(f"""WITH {POPULATION}, t AS (SELECT count(*) FILTER (decile <= 2) nl, count(*) FILTER (decile >= 7) nh, count(*) FILTER (decile <= 2 AND flagged) fl, count(*) FILTER (decile >= 7 AND flagged) fh,
count(*) FILTER (decile <= 2 AND truly = 1) tl, count(*) FILTER (decile >= 7 AND truly = 1) th, count(*) FILTER (decile <= 2 AND truly = 1 AND flagged) hl, count(*) FILTER (decile >= 7 AND truly = 1 AND flagged) hh FROM p),
m AS (SELECT fl * 1000 // greatest(1, nl) AS flag_rate_low, fh * 1000 // greatest(1, nh) AS flag_rate_high, tl * 1000 // greatest(1, nl) AS true_rate_low, th * 1000 // greatest(1, nh) AS true_rate_high, hl * 1000 // greatest(1, fl) AS precision_low, hh * 1000 // greatest(1, fh) AS precision_high FROM t)
SELECT *, flag_rate_low * 1000 // greatest(1, flag_rate_high) AS disparity, true_rate_low * 1000 // greatest(1, true_rate_high) AS true_disparity, greatest(0, flag_rate_low * 1000 // greatest(1, flag_rate_high) - true_rate_low * 1000 // greatest(1, true_rate_high)) AS unexplained FROM m""")
def bias_report(spark, d):
    return evaluation.bias(population(spark, d))


@query(f"""WITH {POPULATION}, s AS (SELECT score, count(*) n, count(*) FILTER (truly = 1) q FROM p GROUP BY 1), c AS (SELECT score, CAST(sum(n) OVER w AS BIGINT) fl, CAST(sum(q) OVER w AS BIGINT) tp, CAST(sum(q) OVER () AS BIGINT) al FROM s WINDOW w AS (ORDER BY score DESC)),
m AS (SELECT score, tp * 1000 // greatest(1, fl) AS precision, tp * 1000 // greatest(1, al) AS recall FROM c WHERE tp > 0), f AS (SELECT *, 2 * precision * recall // greatest(1, precision + recall) AS f1 FROM m) SELECT * FROM f ORDER BY f1 DESC, score LIMIT 1""")
def threshold_fit(spark, d):
    return evaluation.threshold_fit(population(spark, d))


@query("""WITH x AS (SELECT doc_id % 100 AS x, n_chars AS y FROM documents), m AS (SELECT CAST(sum(x) // count(*) AS BIGINT) AS mx, CAST(sum(y) // count(*) AS BIGINT) AS my FROM x), t AS (SELECT CAST(sum((x - mx) * (y - my)) AS BIGINT) xy, CAST(sum((x - mx) * (x - mx)) AS BIGINT) xx, any_value(mx) mx, any_value(my) my FROM x, m),
s AS (SELECT CAST(floor(xy * 1000000 / greatest(1, xx)) AS BIGINT) AS slope_millionths, mx, my FROM t) SELECT slope_millionths, my * 1000000 - slope_millionths * mx AS intercept_millionths FROM s""")
def least_squares(spark, d):
    return evaluation.least_squares(tables.table(spark, d, "documents").select((F.col("doc_id") % 100).alias("x"), F.col("n_chars").alias("y")))


@query(" UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS n, count(*) - count({c}) AS missing, CAST(min({c}) AS BIGINT) AS low, CAST(max({c}) AS BIGINT) AS high, CAST(sum({c}) // greatest(1, count({c})) AS BIGINT) AS mean FROM labels" for c in ("doc_id", "quality", "toxic")))
def baseline_stats(spark, d):
    return evaluation.baseline(tables.table(spark, d, "labels"), ["doc_id", "quality", "toxic"])


@query("""WITH l AS (SELECT CAST(doc_id AS VARCHAR) || '|' || CAST(quality AS VARCHAR) || '|' || CAST(toxic AS VARCHAR) AS line FROM labels), b AS (SELECT substr(sha256(line), 1, 2) AS b, sha256(string_agg(line, chr(10) ORDER BY line)) AS d FROM l GROUP BY 1) SELECT sha256(string_agg(d, chr(10) ORDER BY b)) AS digest FROM b""")
def dataset_digest(spark, d):
    return evaluation.digest(tables.table(spark, d, "labels"), [], F.concat_ws("|", "doc_id", "quality", "toxic"))


#: Rows of the ledger spoilt on purpose: by which interval they are of, so that each rule is broken by some.
SPOIL = {"energy_wh": (50, "-1"), "closed_at": (60, "interval_start_ms"), "meter_id": (70, "NULL"), "lineage_id": (110, "NULL"), "supersedes": (40, "NULL")}
SPOILT_SQL = ", ".join(f"CASE WHEN interval_start_ms // 900000 % {k} = 0 THEN {v} ELSE {c} END AS {c}" for c, (k, v) in SPOIL.items())


def spoilt(rows: DataFrame) -> DataFrame:
    out = rows.withColumns({c: F.expr(f"CASE WHEN interval_start_ms div 900000 % {k} = 0 THEN {v} ELSE {c} END") for c, (k, v) in SPOIL.items()})
    out = out.withColumn("closed_at", F.expr("CASE WHEN interval_start_ms div 900000 % 80 = 0 THEN NULL ELSE closed_at END"))
    return out.unionByName(out.filter("interval_start_ms div 900000 % 90 = 0"))


@query(DAY_SQL + f""", s0 AS (SELECT interval_start_ms, kind, revision, cause, {SPOILT_SQL} FROM lg), s1 AS (SELECT * REPLACE (CASE WHEN interval_start_ms // 900000 % 80 = 0 THEN NULL ELSE closed_at END AS closed_at) FROM s0),
s AS (SELECT * FROM s1 UNION ALL SELECT * FROM s1 WHERE interval_start_ms // 900000 % 90 = 0)
SELECT 'closed_complete' AS rule, count(*) AS violations FROM s WHERE closed_at IS NULL UNION ALL SELECT 'closed_window', count(*) FROM s WHERE closed_at < interval_start_ms + 900000 UNION ALL SELECT 'energy_not_negative', count(*) FROM s WHERE energy_wh < 0
UNION ALL SELECT 'key_unique', count(*) FROM (SELECT 1 FROM s WHERE kind <> 'confirmed' GROUP BY meter_id, interval_start_ms, revision HAVING count(*) > 1) UNION ALL SELECT 'lineage_complete', count(*) FROM s WHERE lineage_id IS NULL
UNION ALL SELECT 'meter_complete', count(*) FROM s WHERE meter_id IS NULL UNION ALL SELECT 'supersedes_where_cause', count(*) FROM s WHERE cause IS NOT NULL AND supersedes IS NULL""")
def dq_rules(spark, d):
    return evaluation.quality_rules(spoilt(staged(ledger(spark, d))))


@query("""SELECT 'not_null_toxic' AS test, count(*) FILTER (toxic IS NULL) AS violations FROM labels UNION ALL SELECT 'range_n_chars', (SELECT count(*) FROM documents WHERE n_chars < 100 OR n_chars > 2000)
UNION ALL SELECT 'unique_lang_n_chars', (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM documents GROUP BY lang, n_chars)) FROM labels""".replace("FROM labels UNION ALL SELECT 'range", "FROM labels UNION ALL SELECT 'range").replace(")) FROM labels", "))"))
def column_tests(spark, d):
    docs = tables.table(spark, d, "documents")
    one = evaluation.column_tests(tables.table(spark, d, "labels"), not_null=["toxic"])
    return one.unionByName(evaluation.column_tests(docs, ranges={"n_chars": (100, 2000)}, unique=["lang", "n_chars"]))


#: The second run lies two intervals and a day later, has another value for some windows, and lacks others.
@query(DAY_SQL + """, b AS (SELECT meter_id, interval_start_ms + 88200000 AS interval_start_ms, energy_wh + CASE WHEN interval_start_ms // 900000 % 17 = 0 THEN 1 ELSE 0 END AS energy_wh, revision FROM nw WHERE interval_start_ms // 900000 % 23 <> 0)
SELECT CAST(-88200000 AS BIGINT) AS offset_ms, count(*) AS shared, (SELECT count(*) FROM nw) AS most, count(*) FILTER (nw.energy_wh <> b.energy_wh) AS differing FROM nw JOIN b ON nw.meter_id = b.meter_id AND nw.interval_start_ms = b.interval_start_ms - 88200000""")
def replay_compare(spark, d):
    first = staged(intervals(spark, d).select("meter_id", "interval_start_ms", "energy_wh", "revision"))
    second = first.filter("interval_start_ms div 900000 % 23 <> 0").withColumns({"energy_wh": F.expr("energy_wh + if(interval_start_ms div 900000 % 17 = 0, 1, 0)"), "interval_start_ms": F.expr("interval_start_ms + 88200000")})
    return evaluation.replayed(first, second, ["energy_wh", "revision"], timeutil.INTERVAL)


@query(DAY_SQL + "SELECT count(*) AS windows, CAST(0 AS BIGINT) AS differing FROM nw")
def replay_redelivered(spark, d):
    """The day with a third of its readings delivered once more, a second later: what is stated last differs nowhere."""
    r, closes, t = closed(spark, d)
    more = r.unionByName(r.filter("event_id % 3 = 0").withColumn("ingest_ms", F.col("ingest_ms") + 1))
    a, b = (windows.newest(windows.ledger(x, closes, t)).select("meter_id", "interval_start_ms", "energy_wh", "revision") for x in (r, more))
    both = a.join(b.select("meter_id", "interval_start_ms", F.col("energy_wh").alias("e"), F.col("revision").alias("v")), ["meter_id", "interval_start_ms"], "full_outer")
    return both.agg(F.count("energy_wh").alias("windows"), F.count_if(~F.col("energy_wh").eqNullSafe(F.col("e")) | ~F.col("revision").eqNullSafe(F.col("v"))).alias("differing"))


@query(BASE + "SELECT sub, event_id, event_ms FROM (SELECT *, row_number() OVER (PARTITION BY sub ORDER BY event_ms DESC, event_id) AS k FROM e) WHERE k <= 5")
def top_n_per_group(spark, d):
    w = Window.partitionBy("partition").orderBy(F.desc("event_ms"), "event_id")
    return tables.events(spark, d).withColumn("k", F.row_number().over(w)).filter("k <= 5").select(F.col("partition").alias("sub"), "event_id", "event_ms")


@query(BASE + "SELECT meter_id, max(wh) AS peak_wh, arg_max(event_id, (wh, -event_id)) AS event_id FROM e GROUP BY 1")
def arg_max(spark, d):
    e = tables.events(spark, d)
    return e.groupBy("meter_id").agg(F.max("wh").alias("peak_wh"), F.max_by("event_id", F.struct(F.col("wh"), -F.col("event_id"))).alias("event_id"))


@query(BASE + "SELECT event_id, strftime(make_timestamp(event_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso, event_ms - event_ms % 900000 AS floor_ms, event_ms AS back_ms FROM e")
def time_functions(spark, d):
    e = tables.events(spark, d)
    iso = timeutil.to_iso(F.col("event_ms"))
    return e.select("event_id", iso.alias("iso"), timeutil.floor_to(F.col("event_ms"), timeutil.INTERVAL).alias("floor_ms"), timeutil.from_iso(iso).alias("back_ms"))


@query(BASE + "SELECT meter_id, interval_start_ms, energy_wh FROM c")
def stream_collapse(spark, d):
    """Arrivals streamed file by file into tables, then collapsed: the same as in one batch."""
    from tidegrid.streaming import ingest

    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    tables.arrivals(spark, d).repartition(3).write.parquet(f"{folder}/in")
    ingest.ingest(ingest.arrival_stream(spark, f"{folder}/in"), folder).awaitTermination()
    r = spark.read.parquet(f"{folder}/readings")
    return dedup.collapsed(r).select("meter_id", "interval_start_ms", "energy_wh")


REVIEWS_SQL = "rv AS (SELECT doc_id AS decision_id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'r' || (doc_id % 3) END AS reviewer, CASE WHEN quality = 1 THEN 'accepted' ELSE 'rejected' END AS verdict, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'why' END AS reason, CAST(0 AS BIGINT) AS at_ms FROM labels), ok AS (SELECT * FROM rv WHERE reviewer <> '' AND (verdict = 'accepted' OR reason <> '') AND decision_id IN (SELECT doc_id FROM documents))"


def reviewed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Documents as entries of the oversight queue, and the reviews of them that can be recorded."""
    entries = tables.table(spark, d, "documents").select(F.col("doc_id").alias("decision_id"))
    k = F.col("doc_id")
    reviews = tables.table(spark, d, "labels").select(
        k.alias("decision_id"), F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("r"), (k % 3).cast("string"))).alias("reviewer"), F.when(F.col("quality") == 1, "accepted").otherwise("rejected").alias("verdict"),
        F.when(k % 5 == 0, "").otherwise("why").alias("reason"), F.lit(0).cast("long").alias("at_ms"),
    )
    return entries, decisions.recorded(entries, reviews)


@query(f"WITH {REVIEWS_SQL} SELECT doc_id AS decision_id FROM documents WHERE doc_id NOT IN (SELECT decision_id FROM ok)")
def oversight_pending(spark, d):
    return decisions.pending(*reviewed(spark, d))


@query(f"WITH {REVIEWS_SQL} SELECT decision_id FROM ok WHERE verdict = 'accepted'")
def oversight_actuated(spark, d):
    return decisions.actuated(*reviewed(spark, d))


@query(f"WITH {REVIEWS_SQL} SELECT decision_id, reviewer, reason FROM ok WHERE verdict = 'rejected'")
def oversight_signal(spark, d):
    return decisions.training_signal(*reviewed(spark, d))


@query(f"""WITH {POPULATION}, m AS (SELECT count(*) FILTER (decile <= 2) AS n, count(*) FILTER (decile <= 2 AND flagged) AS f, count(*) FILTER (decile <= 2 AND truly = 1) AS p, count(*) FILTER (decile <= 2 AND truly = 1 AND flagged) AS h FROM p),
l AS (SELECT count(*) FILTER (decile >= 7) AS n, count(*) FILTER (decile >= 7 AND flagged) AS f, count(*) FILTER (decile >= 7 AND truly = 1) AS p, count(*) FILTER (decile >= 7 AND truly = 1 AND flagged) AS h FROM p)
SELECT m.f * 1000 // m.n - l.f * 1000 // l.n AS positive_proportion_difference, (1000 - m.f * 1000 // m.n) * 1000 // (1000 - l.f * 1000 // l.n) AS disparate_impact, m.h * 1000 // m.p - l.h * 1000 // l.p AS recall_difference FROM m, l""")
def fairness_report(spark, d):
    return evaluation.fairness(population(spark, d).withColumn("confirmed", F.col("truly") == 1))


@query(BASE + "SELECT p AS principal, m AS resource FROM (VALUES ('ops'), ('audit')) a(p) CROSS JOIN (SELECT DISTINCT meter_id AS m, sub FROM e) x WHERE NOT (p = 'ops' AND sub IN ('SUB-01', 'SUB-02')) AND NOT (p = 'audit' AND sub = 'SUB-03')")
def policy_denied(spark, d):
    grants = spark.createDataFrame([("ops", {"kind": ["energy"], "sub": ["SUB-01", "SUB-02"]}), ("audit", {"kind": ["energy", "labels"], "sub": ["SUB-03"]})], "principal string, allowed map<string, array<string>>")
    e = tables.events(spark, d).select(F.col("meter_id").alias("resource"), "partition").distinct()
    return policies.denied(grants, e.select("resource", F.create_map(F.lit("kind"), F.lit("energy"), F.lit("sub"), F.col("partition")).alias("tags")))


@query("SELECT 1000 + 3 * (doc_id % 100) - 2 * n_chars AS score, doc_id FROM documents")
def model_score(spark, d):
    docs = tables.table(spark, d, "documents").select("doc_id", (F.col("doc_id") % 100).alias("x"), F.col("n_chars").alias("y"))
    return evaluation.scored(docs, 1000, {"x": 3, "y": -2}).select("score", "doc_id")
