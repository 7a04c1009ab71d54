"""Erasure: its scope, deletions bounded by ownership, verdicts on each leg and the certificate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.timeutil import from_feature_time

#: The legs of an erasure in the order they are reported; the one that can only be bounded; states of a destroyed key. Fixed values.
LEGS = ["crypto_shred", "lakehouse_rows", "offline_store", "online_store", "training_sets", "model_artefacts"]
BOUNDABLE = "model_artefacts"
SHREDDED = ["PendingDeletion", "PendingReplicaDeletion", "Disabled"]


def erased(rows: DataFrame, assignments: DataFrame, customer: str) -> DataFrame:
    """rows (meter_id, at) without those of a customer's meters while they were the customer's."""
    own = assignments.filter(F.col("customer_id") == customer)
    cond = [rows["meter_id"] == own["meter_id"], rows["at"] >= own["valid_from"], own["valid_to"].isNull() | (rows["at"] < own["valid_to"])]
    return rows.join(own, cond, "left_anti")


def owned(rows: DataFrame, assignments: DataFrame, customer: str) -> DataFrame:
    """How many rows were the customer's, and how many were those of others before or after on the same meters."""
    own = assignments.filter(F.col("customer_id") == customer)
    meters = rows.join(own.select("meter_id").distinct(), "meter_id", "left_semi")
    left = erased(meters, assignments, customer).agg(F.count(F.lit(1)).alias("others"))
    return meters.agg(F.count(F.lit(1)).alias("all_")).join(left, F.lit(True)).select((F.col("all_") - F.col("others")).alias("subject"), "others")


def offline_erased(rows: DataFrame, assignments: DataFrame, customer: str) -> DataFrame:
    """As erased for an offline store (entity_id, event_time as text), whose tombstones (deleted) stay."""
    timed = rows.withColumns({"meter_id": F.col("entity_id"), "at": F.timestamp_millis(from_feature_time(F.col("event_time")))})
    live = erased(timed.filter("NOT deleted"), assignments, customer)
    return live.unionByName(timed.filter("deleted")).drop("meter_id", "at")


def training_erased(rows: DataFrame, customer: str) -> DataFrame:
    return rows.filter(~F.col("customer_id").eqNullSafe(F.lit(customer)))


def forgotten(state: DataFrame, entity: str) -> tuple[DataFrame, bool]:
    """An online store's state without an entity, and whether the entity was in it."""
    return state.filter(F.col("entity_id") != entity), not state.filter(F.col("entity_id") == entity).isEmpty()


def verdicts(observations: DataFrame, legs: list[str] = LEGS) -> DataFrame:
    """leg, place (in the order of the scope) and finding: confirmed, contradicted or unobservable.

    observations: leg, rows (null if it could not be counted), key_state, shred_marker, residual, unobservable_because. What
    could not be looked at is told before any rule; a leg nobody looked at is unobservable, one outside the scope contradicted.
    """
    spark: SparkSession = observations.sparkSession
    expected = spark.createDataFrame(list(zip(legs, range(len(legs)), strict=True)), "leg string, place int")
    seen = observations.withColumn("_seen", F.lit(True))
    blank = F.trim(F.coalesce("residual", F.lit(""))) == ""
    shred = F.when(F.col("key_state").isin(*SHREDDED), "confirmed").when(F.col("key_state").isNotNull(), "contradicted").when(F.coalesce("shred_marker", F.lit(False)), "confirmed").otherwise("unobservable")
    deletion = F.when(F.col("rows").isNull(), "unobservable").when(F.col("rows") > 0, "contradicted").otherwise("confirmed")
    finding = (
        F.when(F.col("place").isNull(), "contradicted").when(F.col("_seen").isNull() | (F.coalesce("unobservable_because", F.lit("")) != ""), "unobservable")
        .when(F.col("leg") == "crypto_shred", shred).when(F.col("leg") == BOUNDABLE, F.when(blank, "contradicted").otherwise("confirmed")).otherwise(deletion)
    )
    return expected.join(seen, "leg", "full_outer").select("leg", "place", finding.alias("finding"))


def certificate(outcomes: dict[str, str], legs: list[str] = LEGS) -> dict[str, str]:
    """The outcomes of all legs; refused if one failed, wasn't attempted or has no entry, or is bounded and can't be."""
    lacking = [leg for leg in legs if outcomes.get(leg, "not_attempted") in ("failed", "not_attempted")]
    bounded = [leg for leg, outcome in outcomes.items() if outcome == "bounded" and leg != BOUNDABLE]
    if lacking or bounded:
        raise ValueError(f"no certificate: incomplete {lacking}, wrongly bounded {bounded}")
    return {leg: outcomes[leg] for leg in legs}
