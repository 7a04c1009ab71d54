"""Bias by tercile, threshold fit, integer least squares, baselines, digests and data-quality rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.scalars import floor_div


def per_mille(a: Column, b: Column) -> Column:
    return floor_div(a * 1000, F.greatest(F.lit(1), b))


def bias(population: DataFrame) -> DataFrame:
    """population: decile, score, truly; rates of the deprived (decile <= 2) and affluent (>= 7) at a threshold column flagged."""
    low, high, hit = F.col("decile") <= 2, F.col("decile") >= 7, F.col("flagged") & (F.col("truly") == 1)
    n = lambda c: F.count_if(c)
    t = population.agg(
        n(low).alias("nl"), n(high).alias("nh"), n(low & F.col("flagged")).alias("fl"), n(high & F.col("flagged")).alias("fh"), n(low & (F.col("truly") == 1)).alias("tl"), n(high & (F.col("truly") == 1)).alias("th"),
        n(low & hit).alias("hl"), n(high & hit).alias("hh"),
    )
    t = t.select(
        per_mille(F.col("fl"), F.col("nl")).alias("flag_rate_low"), per_mille(F.col("fh"), F.col("nh")).alias("flag_rate_high"), per_mille(F.col("tl"), F.col("nl")).alias("true_rate_low"), per_mille(F.col("th"), F.col("nh")).alias("true_rate_high"),
        per_mille(F.col("hl"), F.col("fl")).alias("precision_low"), per_mille(F.col("hh"), F.col("fh")).alias("precision_high"),
    )
    t = t.withColumns({"disparity": per_mille(F.col("flag_rate_low"), F.col("flag_rate_high")), "true_disparity": per_mille(F.col("true_rate_low"), F.col("true_rate_high"))})
    return t.withColumn("unexplained", F.greatest(F.lit(0), F.col("disparity") - F.col("true_disparity")))


def fairness(population: DataFrame) -> DataFrame:
    """What can be told without the truth, per mille: the difference of flagged shares (deprived less affluent), the ratio of
    unflagged shares, and the difference of recall over confirmed cases. An empty denominator gives 0.

    population: decile, flagged, confirmed; an error if a tercile has nobody.
    """
    rate = lambda a, b: F.when(b == 0, F.lit(0)).otherwise(floor_div(a * 1000, F.greatest(F.lit(1), b)))
    of = {"m": F.col("decile") <= 2, "l": F.col("decile") >= 7}
    t = population.agg(*[F.count_if(x & c).alias(f"{k}{g}") for g, x in of.items() for k, c in (("n", F.lit(True)), ("f", F.col("flagged")), ("p", F.col("confirmed")), ("h", F.col("confirmed") & F.col("flagged")))])
    t = t.filter(F.when((F.col("nm") == 0) | (F.col("nl") == 0), F.raise_error(F.lit("both terciles must be populated")).cast("boolean")).otherwise(F.lit(True)))
    flagged = {g: rate(F.col(f"f{g}"), F.col(f"n{g}")) for g in of}
    return t.select(
        (flagged["m"] - flagged["l"]).alias("positive_proportion_difference"), rate(1000 - flagged["m"], 1000 - flagged["l"]).alias("disparate_impact"),
        (rate(F.col("hm"), F.col("pm")) - rate(F.col("hl"), F.col("pl"))).alias("recall_difference"),
    )


def scored(rows: DataFrame, intercept: int, coefficients: dict[str, int]) -> DataFrame:
    """rows with the integer score of a linear model."""
    return rows.withColumn("score", sum((F.col(c) * k for c, k in coefficients.items()), F.lit(intercept).cast("long")))


#: Floors and ceilings of a promotion, per mille.
THRESHOLDS = {"precision": 600, "recall": 800, "disparity": 200, "precision_gap": 300}


def promotion(candidates: DataFrame, thresholds: dict[str, int] = THRESHOLDS, forbidden: tuple[str, ...] = ("pipeline", "system")) -> DataFrame:
    """candidates with refusal, the first rule that a promotion breaks; null if it may go ahead. Parity can't be waived by anybody.

    candidates: parity (boolean), approver, waivers (an array), card_digest, model_digest, precision, recall, unexplained,
    precision_low, precision_high.
    """
    waived = lambda k: F.array_contains(F.coalesce("waivers", F.array().cast("array<string>")), k)
    refusal = (
        F.when(waived("parity"), "parity_waiver_attempted").when(~F.coalesce("parity", F.lit(False)), "parity")
        .when(F.lower(F.trim(F.coalesce("approver", F.lit("system")))).isin(*forbidden), "self_approval").when(F.col("card_digest").isNull(), "model_card_missing").when(F.col("card_digest") != F.col("model_digest"), "model_card_stale")
        .when((F.coalesce("precision", F.lit(0)) < thresholds["precision"]) & ~waived("precision"), "precision").when((F.coalesce("recall", F.lit(0)) < thresholds["recall"]) & ~waived("recall"), "recall")
        .when((F.col("unexplained") > thresholds["disparity"]) & ~waived("disparity"), "disparity").when((F.abs(F.col("precision_low") - F.col("precision_high")) > thresholds["precision_gap"]) & ~waived("precision_gap"), "precision_gap")
    )
    return candidates.withColumn("refusal", refusal)


def reproduced(first: DataFrame, second: DataFrame, key: str, strict: bool) -> DataFrame:
    """Runs of both tables with the first field that differs (null if none): snapshot, data_digest, metrics and, if strict, artefact_digest."""
    fields = ["snapshot", "data_digest", "metrics", *(["artefact_digest"] if strict else [])]
    both = first.alias("a").join(second.alias("b"), key)
    return both.select(key, F.coalesce(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), c) for c in fields]).alias("differs"))


def threshold_fit(population: DataFrame) -> DataFrame:
    """The score at or above which to flag for the best per-mille F1; the lowest of equals; none without a true positive."""
    per = population.groupBy("score").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("truly") == 1).alias("p"))
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)  # over distinct scores
    c = per.withColumns({"flagged": F.sum("n").over(above), "tp": F.sum("p").over(above)}).crossJoin(population.agg(F.count_if(F.col("truly") == 1).alias("all_p"))).filter("tp > 0")
    c = c.withColumns({"precision": per_mille(F.col("tp"), F.col("flagged")), "recall": per_mille(F.col("tp"), F.col("all_p"))})
    c = c.withColumn("f1", floor_div(2 * F.col("precision") * F.col("recall"), F.greatest(F.lit(1), F.col("precision") + F.col("recall"))))
    best = c.agg(F.max_by(F.struct("score", "precision", "recall", "f1"), F.struct(F.col("f1"), -F.col("score"))).alias("b"))
    return best.select("b.*")


def least_squares(rows: DataFrame) -> DataFrame:
    """Slope and intercept of y on x in millionths, from integer sums and floor divisions."""
    s = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"))
    m = s.select(floor_div(F.col("sx"), F.col("n")).alias("mx"), floor_div(F.col("sy"), F.col("n")).alias("my"))
    t = rows.crossJoin(F.broadcast(m)).agg(F.sum(F.expr("(x - mx) * (y - my)")).alias("xy"), F.sum(F.expr("(x - mx) * (x - mx)")).alias("xx"), F.first("mx").alias("mx"), F.first("my").alias("my"))
    t = t.withColumn("slope_millionths", floor_div(F.col("xy") * 1_000_000, F.greatest(F.lit(1), F.col("xx"))))
    return t.select("slope_millionths", (F.col("my") * 1_000_000 - F.col("slope_millionths") * F.col("mx")).alias("intercept_millionths"))


def baseline(rows: DataFrame, columns: list[str]) -> DataFrame:
    """count, missing, min, max and floored mean of each column, in one pass."""
    one = rows.agg(*[F.struct(F.lit(c).alias("name"), F.count(c).alias("n"), F.count_if(F.col(c).isNull()).alias("missing"), F.min(c).cast("long").alias("low"), F.max(c).cast("long").alias("high"), floor_div(F.sum(c).cast("long"), F.greatest(F.lit(1), F.count(c))).alias("mean")).alias(c) for c in columns])
    return one.select(F.explode(F.array(*columns)).alias("r")).select("r.*")


def digest(rows: DataFrame, key: list[str], line: Column) -> DataFrame:
    """A content-ordered digest: of each bucket of rows apart, then of the buckets' digests, so no list holds all rows."""
    per = rows.select(line.alias("line"), *key).withColumn("b", F.substring(F.sha2("line", 256), 1, 2))
    parts = per.groupBy("b").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("line")), "\n"), 256).alias("d"))
    return parts.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "d"))), lambda x: x["d"]), "\n"), 256).alias("digest"))


def quality_rules(ledger: DataFrame) -> DataFrame:
    """Violations by rule; the key rule counts keys with more than one row."""
    one = ledger.agg(
        F.count_if(F.col("energy_wh") < 0).alias("energy_not_negative"), F.count_if(F.col("cause").isNotNull() & F.col("supersedes").isNull()).alias("supersedes_where_cause"),
        F.count_if(F.col("meter_id").isNull()).alias("meter_complete"), F.count_if(F.col("lineage_id").isNull()).alias("lineage_complete"), F.count_if(F.col("closed_at").isNull()).alias("closed_complete"), F.count_if(F.col("closed_at") < F.col("interval_start_ms") + 900_000).alias("closed_window"),
    )
    keys = ledger.filter("kind <> 'confirmed'").groupBy("meter_id", "interval_start_ms", "revision").count().filter("count > 1").agg(F.count(F.lit(1)).alias("key_unique"))
    both = one.crossJoin(keys)
    return both.select(F.explode(F.array(*[F.struct(F.lit(c).alias("rule"), F.col(c).alias("violations")) for c in sorted(both.columns)])).alias("r")).select("r.*")


def column_tests(rows: DataFrame, not_null: list[str] = (), ranges: dict[str, tuple[int | None, int | None]] | None = None, unique: list[str] = ()) -> DataFrame:
    """Violations by test: nulls of a column, values outside its range (null passes), surplus rows of a combination that should be unique."""
    checks = {f"not_null_{c}": F.count_if(F.col(c).isNull()) for c in not_null}
    for c, (low, high) in (ranges or {}).items():
        checks[f"range_{c}"] = F.count_if(((F.col(c) < low) if low is not None else F.lit(False)) | ((F.col(c) > high) if high is not None else F.lit(False)))
    one = rows.agg(*[c.alias(k) for k, c in checks.items()]) if checks else rows.sparkSession.range(1).select()
    if unique:
        name = f"unique_{'_'.join(unique)}"
        checks[name] = None
        one = one.crossJoin(rows.groupBy(*unique).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name)))
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("test"), F.col(k).cast("long").alias("violations")) for k in checks])).alias("r")).select("r.*")


def replayed(first: DataFrame, second: DataFrame, values: list[str], grid_ms: int, reach: int = 4) -> DataFrame:
    """One row about two runs of one day (meter_id, interval_start_ms, values) that may lie some time apart: offset_ms, by which the
    second agrees most with the first, and then how many keys both have (shared), of how many (most), and how many of these differ.

    Offsets are tried around the difference of the two medians, reach steps of the grid either way; the one nearest to it
    wins a tie. Each row of the second meets the first at one key an offset, so it is one equality join.
    """
    median = lambda df, n: df.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY interval_start_ms DESC)").alias(n))
    centre = median(first, "a").crossJoin(median(second, "b")).select((F.col("a") - F.col("b")).cast("long").alias("centre"))
    steps = second.crossJoin(F.broadcast(centre)).withColumn("step", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).withColumn("at", F.col("centre") + F.col("step") * grid_ms)
    shifted = steps.select("meter_id", (F.col("interval_start_ms") + F.col("at")).alias("interval_start_ms"), "at", "step", F.struct(*values).alias("y"))
    both = shifted.join(first.select("meter_id", "interval_start_ms", F.struct(*values).alias("x")), ["meter_id", "interval_start_ms"])
    by_step = both.groupBy("step", "at").agg(F.count(F.lit(1)).alias("shared"), F.count_if(F.col("x").eqNullSafe(F.col("y"))).alias("same"))
    best = by_step.agg(F.max_by(F.struct("at", "shared", "same"), F.struct("same", -F.abs("step"), -F.col("step"))).alias("o"))
    sizes = first.agg(F.count(F.lit(1)).alias("n1")).crossJoin(second.agg(F.count(F.lit(1)).alias("n2")))
    return best.crossJoin(sizes).select(F.col("o.at").alias("offset_ms"), F.coalesce("o.shared", F.lit(0).cast("long")).alias("shared"), F.greatest("n1", "n2").alias("most"), F.coalesce(F.expr("o.shared - o.same"), F.lit(0).cast("long")).alias("differing"))
