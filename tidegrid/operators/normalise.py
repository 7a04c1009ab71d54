"""Three payload generations into one integer reading; what is refused is kept with a reason.

arrivals: raw, ingest_ms, source, partition. The reasons are a closed list, tried in a fixed order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.scalars import payload_hash
from tidegrid.functions.timeutil import INTERVAL, MINUTE, duration_text, floor_to, from_iso, to_iso

SKEW_TOLERANCE, MAX_ENERGY = 5 * MINUTE, 10_000_000
#: Watt hours by unit; reasons that redelivery can't mend, and the one that a person may. Fixed values of the wire format.
UNITS = {"Wh": 1, "kWh": 1_000, "MWh": 1_000_000}
TERMINAL = ["unknown_payload_shape", "malformed_field", "unknown_unit", "clock_skew_future", "implausible_value", "precision_beyond_canonical_unit"]
RECOVERABLE = ["too_late_for_window"]
#: One parse gives every field; each keeps its JSON type. Of a key that comes twice the last counts.
PAYLOAD = """v variant, schema variant, schemaVersion variant, mid variant, ts variant, wh variant, meter_id variant, timestamp variant,
    energy struct<value: variant, unit: variant>, meter struct<id: variant>, interval struct<start: variant>"""
#: A number as it is written, for those that a variant holds as a double only (exponents, over 38 digits).
WRITTEN = r'"(?:wh|value)"\s*:\s*(-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)'


def _text(field: str) -> Column:
    """A field's text if it is a JSON string, else null."""
    return F.when(F.schema_of_variant(field) == "STRING", F.col(field).cast("string"))


def _whole_object(raw: str) -> Column:
    """Whether raw is one JSON object and nothing else: put into an object before a key that it can't hold, both are all the keys."""
    mark = F.md5(raw)
    keys = F.json_object_keys(F.concat(F.lit('{"r":'), F.col(raw), F.lit(',"'), mark, F.lit('":1}')))
    return F.col(raw).rlike(r"^\s*\{") & (keys == F.array(F.lit("r"), mark))


def _once(rows: DataFrame, kept: list[str], **columns: Column) -> DataFrame:
    """rows with columns computed once, however many expressions use them.

    What explode makes can't be copied into each use, as the optimiser does with a projection; kept columns stay outside it, so
    filters on them and the choice of columns still reach the scan.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return rows.select(*kept, F.explode(F.array(made)).alias("_m")).select(*kept, "_m.*")


def normalised(arrivals: DataFrame) -> DataFrame:
    """arrivals with meter_id, event_ms, interval_start_ms, energy_wh, firmware, payload_hash, reason (null if accepted) and detail.

    The first field in a payload's order that doesn't fit gives the reason. Energy is exact: what isn't a whole number of watt
    hours is refused, whatever its length.
    """
    names = arrivals.columns
    v = _once(arrivals, names, _j=F.when(F.coalesce(_whole_object("raw"), F.lit(False)), F.from_json("raw", PAYLOAD, {"allowSingleQuotes": "false"})))
    shape = F.when(F.col("_j.v").isNotNull(), 1).when(F.col("_j.schema").isNotNull(), 2).when(F.col("_j.schemaVersion").isNotNull(), 3)
    by = lambda one, two, three: F.when(shape == 1, one).when(shape == 2, two).when(shape == 3, three)
    amount = F.when(shape == 1, F.col("_j.wh")).otherwise(F.col("_j.energy.value"))
    kind = F.schema_of_variant(amount)
    v = _once(
        v, names, _shape=shape, meter_id=by(_text("_j.mid"), _text("_j.meter_id"), _text("_j.meter.id")),
        event_ms=by(F.when(F.schema_of_variant("_j.ts") == "BIGINT", F.expr("try_multiply(cast(_j.ts as bigint), 1000L)")), from_iso(_text("_j.timestamp")), from_iso(_text("_j.interval.start"))),
        _factor=F.element_at(F.create_map(*[F.lit(x) for kv in UNITS.items() for x in kv]), F.when(shape == 1, F.lit("Wh")).otherwise(_text("_j.energy.unit"))),
        _nested=by(F.lit(True), F.col("_j.energy").isNotNull(), F.col("_j.energy").isNotNull() & F.col("_j.meter").isNotNull() & F.col("_j.interval").isNotNull()),
        _number=F.when(kind.rlike("^(BIGINT|DECIMAL)"), amount.cast("string")).when(kind == "DOUBLE", F.regexp_extract("raw", WRITTEN, 1)),
    )
    # Nine decimals hold every whole number of watt hours in any unit; anything beyond them but noughts is a part of one.
    wh = F.expr("try_cast(_number as decimal(28,9))") * F.col("_factor").cast("decimal(9,0)")
    finer = F.col("_number").rlike(r"\.\d{9}\d*[1-9]") | F.coalesce(F.expr("try_cast(_number as decimal(38,25)) <> try_cast(_number as decimal(28,9))"), F.lit(False))
    v = _once(v, [*names, "_shape", "meter_id", "event_ms", "_factor", "_nested", "_number"], _wh=wh, _finer=finer | ((F.expr("try_cast(_number as decimal(28,9))") == 0) & (F.expr("try_cast(_number as double)") != 0)))
    reasons = [
        (~F.coalesce(F.col("source").isin("stream", "batch"), F.lit(False)), "unknown_payload_shape", F.concat(F.lit("source is "), F.coalesce("source", F.lit("null")))),
        (F.col("_shape").isNull(), "unknown_payload_shape", F.lit("no object of a known shape")),
        (F.coalesce(F.col("meter_id"), F.lit("")) == "", "malformed_field", F.lit("the meter's id is no text, or empty")),
        (~F.col("_nested"), "malformed_field", F.lit("an object is missing")),
        (F.col("event_ms").isNull(), "malformed_field", F.lit("the time is missing, or has no offset, or can't be read")),
        (F.col("_factor").isNull(), "unknown_unit", F.lit("the unit is none of " + ", ".join(UNITS))),
        (F.coalesce(F.col("_number"), F.lit("")) == "", "malformed_field", F.lit("the energy is no number")),
        (F.col("_wh").isNull(), "implausible_value", F.lit("the energy is beyond any meter")),
        (F.col("_finer") | (F.col("_wh") != F.floor("_wh")), "precision_beyond_canonical_unit", F.concat(F.col("_number"), F.lit(" is no whole number of watt hours"))),
        ((F.col("_wh") < 0) | (F.col("_wh") > MAX_ENERGY), "implausible_value", F.concat(F.col("_number"), F.lit(" is below nought or above the ceiling"))),
        (F.col("event_ms") - F.col("ingest_ms") > SKEW_TOLERANCE, "clock_skew_future", F.concat(F.lit("the time is "), duration_text(F.col("event_ms") - F.col("ingest_ms")), F.lit(" ahead"))),
    ]
    refusal = F.coalesce(*[F.when(wrong, F.struct(F.lit(reason).alias("reason"), detail.alias("detail"))) for wrong, reason, detail in reasons])
    v = _once(v, [*names, "meter_id", "event_ms", "_shape", "_wh"], _no=refusal)
    good = F.col("_no").isNull()
    return v.select(
        *names, "meter_id", "event_ms", floor_to(F.col("event_ms"), INTERVAL).alias("interval_start_ms"), F.when(good, F.col("_wh").cast("long")).alias("energy_wh"), F.concat(F.lit("fw"), F.col("_shape").cast("string")).alias("firmware"),
        F.when(good, payload_hash(F.col("meter_id"), floor_to(F.col("event_ms"), INTERVAL), F.col("_wh").cast("long"))).alias("payload_hash"), F.col("_no.reason").alias("reason"), F.col("_no.detail").alias("detail"),
    )


def transported(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """records (raw in base64, topic, at_ms) as arrivals, and one line of kind quarantine for each that isn't base64 of UTF-8.

    The topic's third part is the partition; what comes by a topic that ends in backfill is a batch. Transport decides
    nothing about a payload, so its own reason stands outside the closed list.
    """
    r = records.withColumns({
        "partition": F.element_at(F.split("topic", "/"), 3), "source": F.when(F.col("topic").endswith("/backfill"), "batch").otherwise("stream"),
        "_text": F.try_validate_utf8(F.expr("try_to_binary(raw, 'base64')").cast("string")),
    })
    good = r.filter("_text IS NOT NULL").select(*[c for c in records.columns if c not in ("raw", "topic", "at_ms", "partition", "source")], F.col("_text").alias("raw"), F.col("at_ms").alias("ingest_ms"), "source", "partition")
    return good, r.filter("_text IS NULL").select(F.lit("quarantine").alias("kind"), F.lit("undecodable_transport").alias("reason"), "partition", "source")


def readings(arrivals: DataFrame) -> DataFrame:
    return normalised(arrivals).filter("reason IS NULL").drop("reason", "detail", "raw")


def quarantine(arrivals: DataFrame) -> DataFrame:
    n = normalised(arrivals).filter("reason IS NOT NULL")
    return n.select("reason", F.when(F.col("reason").isin(*RECOVERABLE), "recoverable").otherwise("terminal").alias("disposition"), "detail", F.col("raw").alias("payload"), to_iso(F.col("ingest_ms")).alias("quarantined_at"), "partition", "source")
