"""Rule-based decisions with explicit fallbacks, and their oversight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.scalars import decision_id, throttle
from tidegrid.operators.timeline import MAY_CLOSE


def decided(entities: DataFrame, contract: str, score, threshold: int, fallback, budget_ms: int) -> DataFrame:
    """entities: entity_id, at_ms, clock_status, event_ms and value of the feature (null if missing).

    The reasons are tried in order: the event clock, the window, missing and stale features, the model.
    """
    why = (
        F.when(F.col("clock_status").isin("stalled", "starved"), "clock_stalled")
        .when(~F.col("clock_status").isin(*MAY_CLOSE), "window_not_closed")
        .when(F.col("value").isNull(), "feature_missing")
        .when(F.col("at_ms") - F.col("event_ms") > budget_ms, "feature_stale")
        .when(score.isNull(), "model_unavailable")
    )
    d = entities.withColumn("unavailable", why).withColumn("_f", fallback)
    action = F.when(F.col("unavailable").isNull(), F.when(score >= threshold, "flag").otherwise("pass")).otherwise(F.coalesce("_f", F.lit("none")))
    origin = F.when(F.col("unavailable").isNull(), "model").when(F.col("_f").isNotNull(), "fallback").otherwise("withheld")
    return d.select(decision_id(F.lit(contract), F.col("entity_id"), F.col("at_ms")).alias("decision_id"), "entity_id", "at_ms", action.alias("action"), origin.alias("origin"), "unavailable")


def curtailed(telemetry: DataFrame) -> DataFrame:
    """telemetry: entity_id, at_ms, load_w, limit_w; with headroom and the throttle, if any."""
    t = telemetry.withColumn("headroom_w", F.expr("limit_w - load_w"))
    return t.withColumn("action", throttle(F.col("headroom_w"), F.col("limit_w")))


#: What each rule does when the model can't be asked; null withholds. Fixed names.
FALLBACKS = {
    "proportional_on_measured_load": lambda: throttle(F.col("headroom_w"), F.col("limit_w")),
    "no_queue_entry": lambda: F.lit(None).cast("string"),
    "withhold_and_restate": lambda: F.lit(None).cast("string"),
}


def fallback(rule: str):
    """The column of a fallback rule; an unknown rule is an error, not nothing to do."""
    if rule not in FALLBACKS:
        raise ValueError(f"no fallback rule {rule!r}")
    return FALLBACKS[rule]()


def fallback_rate(decisions: DataFrame) -> DataFrame:
    """The share of decisions that the model didn't take; 0.0 without any."""
    return decisions.agg(F.coalesce(F.avg((F.col("origin") != "model").cast("double")), F.lit(0.0)).alias("fallback_rate"))


def property_violations(decisions: DataFrame, budget_ms: int) -> DataFrame:
    """How many decisions break each property: by the model while no window may close, a fallback without a reason, by the
    model on a feature over its budget, an action that the contract doesn't permit.

    decisions: origin, clock_status, unavailable, age_ms, action, permitted (an array).
    """
    broken = {
        "model_while_window_open": (F.col("origin") == "model") & ~F.col("clock_status").isin(*MAY_CLOSE), "fallback_without_reason": (F.col("origin") != "model") & F.col("unavailable").isNull(),
        "model_on_stale_feature": (F.col("origin") == "model") & (F.col("age_ms") > budget_ms), "action_not_permitted": ~F.array_contains("permitted", F.split("action", ":")[0]) & (F.col("action") != "none"),
    }
    one = decisions.agg(*[F.count_if(c).alias(k) for k, c in broken.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("property"), F.col(k).alias("violations")) for k in broken])).alias("r")).select("r.*")


def from_unclosed_windows(decisions: DataFrame, ledger: DataFrame) -> DataFrame:
    """Decisions on a window (meter_id, interval_start_ms) before any tick that published it."""
    closed = ledger.filter("kind = 'published'").select("meter_id", "interval_start_ms", F.col("at_ms").alias("_closed"))
    both = decisions.join(closed, ["meter_id", "interval_start_ms"], "left")
    return both.filter("_closed IS NULL OR at_ms < _closed").drop("_closed")


def review_problems(decisions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews that can't be recorded: of no entry, by nobody, or a rejection without a reason."""
    known = decisions.select("decision_id").distinct().withColumn("_k", F.lit(True))
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    why = F.when(F.col("_k").isNull(), "no_entry").when(blank("reviewer"), "no_reviewer").when((F.col("verdict") == "rejected") & blank("reason"), "rejection_without_reason")
    return reviews.join(known, "decision_id", "left").withColumn("problem", why).filter("problem IS NOT NULL").drop("_k")


def recorded(decisions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Each entry's last review (at_ms) of those that can be recorded."""
    bad = review_problems(decisions, reviews).select("decision_id", "at_ms", "reviewer")
    good = reviews.join(bad, (reviews["decision_id"] == bad["decision_id"]) & (reviews["at_ms"] == bad["at_ms"]) & reviews["reviewer"].eqNullSafe(bad["reviewer"]), "left_anti")
    return good.groupBy("decision_id").agg(F.max_by(F.struct("reviewer", "verdict", "reason", "at_ms"), F.struct("at_ms", "verdict", "reviewer")).alias("r")).select("decision_id", "r.*")


def pending(decisions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Entries that nobody has reviewed."""
    return decisions.join(reviews.select("decision_id").distinct(), "decision_id", "left_anti")


def actuated(decisions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Decisions that a review accepted; there is no other way to one."""
    return decisions.join(reviews.filter("verdict = 'accepted'").select("decision_id").distinct(), "decision_id", "left_semi")


def training_signal(decisions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Rejected decisions with who rejected them and why."""
    return decisions.join(reviews.filter("verdict = 'rejected'").select("decision_id", "reviewer", "reason"), "decision_id")
