"""Bitemporal features by two independent ways, compared without tolerance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.scalars import mean_half_away


@dataclass(frozen=True)
class FeatureContract:
    """An aggregate over (T - length, T] of event time, seen as of an ingest time."""

    name: str
    aggregation: str
    length_s: int
    grain_s: int
    budget_s: int
    purpose: str = ""
    personal: bool = False
    fractional: bool = False

    def problems(self) -> list[str]:
        out = []
        if self.aggregation not in AGGREGATIONS:
            out.append("unknown aggregation")
        if self.personal and not self.purpose:
            out.append("personal data without a purpose")
        if self.fractional:
            out.append("fractional values")
        if self.length_s % self.grain_s:
            out.append("length is no multiple of the grain")
        if self.budget_s > self.length_s:
            out.append("budget above the length")
        return out


AGGREGATIONS = {
    "sum": lambda v: F.sum(v),
    "mean": lambda v: mean_half_away(F.sum(v), F.count(v)),
    "max": lambda v: F.max(v),
    "min": lambda v: F.min(v),
    "count": lambda v: F.count(v),
    "last": lambda v: F.max_by(v, F.struct("event_ms", "ingest_ms")),
}


def resolved(contract: FeatureContract, rows: DataFrame, at_ms: int, seen_ms: int) -> DataFrame:
    """entity_id and value at one instant; an entity without rows is absent. Both bounds reach the scan."""
    inside = rows.filter((F.col("event_ms") > at_ms - contract.length_s * 1000) & (F.col("event_ms") <= at_ms) & (F.col("ingest_ms") <= seen_ms))
    return inside.groupBy("entity_id").agg(AGGREGATIONS[contract.aggregation](F.col("value")).cast("long").alias("value"))


def served(contract: FeatureContract, rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The value after each event, by a trailing range frame over milliseconds; the last row of an entity is what is served."""
    w = Window.partitionBy(*(keys or ["entity_id"])).orderBy("event_ms").rangeBetween(-(contract.length_s * 1000 - 1), 0)
    over: dict[str, Column] = {
        "sum": F.sum("value").over(w), "mean": F.when(F.count("value").over(w) > 0, mean_half_away(F.sum("value").over(w), F.count("value").over(w))), "max": F.max("value").over(w),
        "min": F.min("value").over(w), "count": F.nullif(F.count("value").over(w), F.lit(0)), "last": F.max_by("value", F.when(F.col("value").isNotNull(), F.struct("event_ms", "ingest_ms"))).over(w),
    }
    return rows.withColumn("served", over[contract.aggregation].cast("long"))


def latest_served(contract: FeatureContract, rows: DataFrame) -> DataFrame:
    """entity_id, event_ms and value that an online store holds after all rows."""
    s = served(contract, rows).groupBy("entity_id").agg(F.max_by(F.struct("event_ms", "served"), "event_ms").alias("x"))
    return s.select("entity_id", F.col("x.event_ms").alias("event_ms"), F.col("x.served").alias("value"))


def resolved_at(contract: FeatureContract, rows: DataFrame, instants: list[int], lag_ms: int) -> DataFrame:
    """entity_id, at_ms and value at each of a declared list of instants, of what had come lag_ms after it.

    A row is dealt to the instants that see it, so nothing joins; the list is a parameter, not data.
    """
    times = F.array(*[F.lit(t).cast("long") for t in instants])
    sees = lambda t: (F.col("event_ms") > t - contract.length_s * 1000) & (F.col("event_ms") <= t) & (F.col("ingest_ms") <= t + lag_ms)
    seen = rows.withColumn("at_ms", F.explode(F.filter(times, sees)))
    return seen.groupBy("entity_id", "at_ms").agg(AGGREGATIONS[contract.aggregation](F.col("value")).cast("long").alias("value"))


def served_at(contract: FeatureContract, rows: DataFrame, instants: list[int], lag_ms: int) -> DataFrame:
    """What a store that takes rows as they come serves at each instant, found by running values and not by the instants' own filter.

    Rows and questions stand in the order of event time within their entity; a question takes the frame that ends with it.
    A row that comes later than an instant's lag allows is not there for it, so rows stand once for each instant that they
    reach in time.
    """
    times = F.array(*[F.lit(t).cast("long") for t in instants])
    marks = rows.withColumn("at_ms", F.explode(F.filter(times, lambda t: F.col("ingest_ms") <= t + lag_ms))).select("entity_id", "at_ms", "event_ms", "ingest_ms", "value")
    asked = rows.select("entity_id").distinct().withColumn("at_ms", F.explode(times)).select("entity_id", "at_ms", F.col("at_ms").alias("event_ms"), F.lit(None).cast("long").alias("ingest_ms"), F.lit(None).cast("long").alias("value"))
    s = served(contract, marks.unionByName(asked), ["entity_id", "at_ms"])
    return s.filter("event_ms = at_ms AND ingest_ms IS NULL AND served IS NOT NULL").select("entity_id", "at_ms", F.col("served").alias("value"))


def as_of_sql(contract: FeatureContract, table: str) -> str:
    """The feature at one instant as SQL with named parameters: :entity, :at_ms and :seen_ms."""
    total, n = "sum(value)", "count(value)"
    made = {
        "sum": total, "max": "max(value)", "min": "min(value)", "count": n, "last": "max_by(value, struct(event_ms, ingest_ms))",
        "mean": f"CASE WHEN {total} >= 0 THEN (2 * {total} + {n}) div (2 * {n}) ELSE -((-2 * {total} + {n}) div (2 * {n})) END",
    }
    return (
        f"SELECT entity_id, CAST({made[contract.aggregation]} AS BIGINT) AS value FROM {table}\n"
        f"WHERE entity_id = :entity AND event_ms > :at_ms - {contract.length_s * 1000} AND event_ms <= :at_ms AND ingest_ms <= :seen_ms\nGROUP BY entity_id"
    )


def resolve_one(contract: FeatureContract, rows: DataFrame, entity: str, at_ms: int, seen_ms: int) -> int | None:
    """The value of one entity by as_of_sql; none without a row."""
    found = rows.sparkSession.sql(as_of_sql(contract, "{rows}"), {"entity": entity, "at_ms": at_ms, "seen_ms": seen_ms}, rows=rows).collect()
    return found[0]["value"] if found else None


def parity(online: DataFrame, offline: DataFrame, keys: list[str]) -> DataFrame:
    """Where the two ways differ: online_missing, offline_missing or value."""
    a, b = online.select(*keys, F.col("value").alias("online")), offline.select(*keys, F.col("value").alias("offline"))
    both = a.join(b, keys, "full_outer").filter(~F.col("online").eqNullSafe(F.col("offline")))
    return both.withColumn("kind", F.when(F.col("online").isNull(), "online_missing").when(F.col("offline").isNull(), "offline_missing").otherwise("value"))
