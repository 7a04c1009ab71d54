"""Exact integer scalars: identities, headroom, throttles, half-away means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegrid.functions.timeutil import to_iso

UNIT_SEPARATOR = "\x1f"


def floor_div(a: Column, b: Column | int) -> Column:
    """Integer division rounding down, for either sign."""
    b = F.lit(b) if isinstance(b, int) else b
    q = F.call_function("div", a, b)
    return q - F.when((a % b != 0) & ((a < 0) != (b < 0)), 1).otherwise(0)


def short_sha(*parts: Column, sep: str) -> Column:
    return F.substring(F.sha2(F.concat_ws(sep, *parts), 256), 1, 32)


def payload_hash(meter: Column, interval_ms: Column, energy: Column) -> Column:
    return short_sha(meter, to_iso(interval_ms), energy.cast("string"), sep="|")


def lineage_of_reading(meter: Column, interval_ms: Column, payload: Column, ingest_ms: Column, source: Column) -> Column:
    return short_sha(F.lit("reading"), meter, to_iso(interval_ms), payload, to_iso(ingest_ms), source, sep=UNIT_SEPARATOR)


def derived(kind: str, key: Column, parents: Column) -> Column:
    """The lineage of what was made of parents (an array, in any order, repeats not counting)."""
    joined = F.array_join(F.array_sort(F.array_distinct(parents)), UNIT_SEPARATOR)
    return short_sha(F.lit(kind), key, F.when(F.size(parents) > 0, joined), sep=UNIT_SEPARATOR)


def lineage_of_result(meter: Column, interval_ms: Column, revision: Column, parents: Column) -> Column:
    return derived("window", F.concat_ws("|", meter, to_iso(interval_ms), F.concat(F.lit("r"), revision.cast("string"))), parents)


def decision_id(contract: Column, entity: Column, at_ms: Column) -> Column:
    return short_sha(F.lit("decision"), contract, entity, at_ms.cast("string"), sep="|")


def utilisation_bp(load: Column, limit: Column) -> Column:
    return F.when(limit <= 0, F.lit(10_000).cast("long")).otherwise(floor_div(load * 10_000, limit))


def throttle(headroom: Column, limit: Column) -> Column:
    """throttle:hold without telemetry, null with headroom, else a percentage of at most 90."""
    over = floor_div(-headroom * 10_000, F.greatest(F.lit(1), limit))
    return F.when(headroom.isNull(), "throttle:hold").when(headroom < 0, F.concat(F.lit("throttle:"), F.least(F.lit(90), floor_div(over * 5, 100)).cast("string")))


def mean_half_away(total: Column, n: Column) -> Column:
    """The integer nearest to total / n, halves away from zero."""
    return F.when(total >= 0, F.call_function("div", 2 * total + n, 2 * n)).otherwise(-F.call_function("div", -2 * total + n, 2 * n))


def meter_of(raw: Column) -> Column:
    """The meter's id in the text of a payload of any generation; null if none is told."""
    return F.nullif(F.regexp_extract(raw, r'"(?:mid|meter_id|id)"\s*:\s*"([^"]*)"', 1), F.lit(""))


def retimed(raw: Column, shift_ms: int) -> Column:
    """A payload's text with its times moved: epoch seconds of "ts", and ISO texts of "timestamp", "start" and "event_time"."""
    from tidegrid.functions.timeutil import from_iso

    seconds = F.regexp_extract(raw, r'"ts"\s*:\s*(-?\d+)', 1)
    moved = F.when(seconds != "", F.regexp_replace(raw, F.lit(r'("ts"\s*:\s*)-?\d+'), F.concat(F.lit("$1"), (seconds.try_cast("long") + shift_ms // 1000).cast("string")))).otherwise(raw)
    iso = F.regexp_extract(raw, r'"(?:timestamp|start|event_time)"\s*:\s*"([^"]*)"', 1)
    later = to_iso(from_iso(iso) + shift_ms)
    return F.when((iso != "") & later.isNotNull(), F.regexp_replace(moved, F.lit(r'("(?:timestamp|start|event_time)"\s*:\s*")[^"]*'), F.concat(F.lit("$1"), later))).otherwise(moved)


def publish_plan(n: Column, span_ms: Column, window_ms: int, burst_s: int) -> Column:
    """How much a span is compressed to fit a window, and the peak deliveries a second of a burst."""
    return F.struct(F.greatest(F.lit(1).cast("long"), floor_div(span_ms, window_ms)).alias("compression"), floor_div(floor_div(n, 96), burst_s).alias("peak_per_second"))
