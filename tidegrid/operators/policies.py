"""Tag policies: what each principal reaches, what it doesn't, and ways a policy can't be trusted.

tags: key, value (the defined ones); resources: resource, tags map<string, string>; grants: principal, allowed
map<string, array<string>>. A grant covers a resource if for every key it names the resource's value is one of its values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reachable(grants: DataFrame, resources: DataFrame) -> DataFrame:
    """principal and resource, once each, where one of the principal's grants covers the resource.

    Each key of a grant meets the resources by an equality of key and value; a grant covers what meets all its keys. A grant
    that names no key covers everything.
    """
    g = grants.withColumn("_g", F.monotonically_increasing_id()).select("principal", "_g", F.size("allowed").alias("_n"), F.explode_outer("allowed").alias("key", "values"))
    named = g.filter("key IS NOT NULL").select("principal", "_g", "_n", "key", F.explode(F.array_distinct("values")).alias("value"))
    tagged = resources.select("resource", F.explode("tags").alias("key", "value"))
    met = named.join(tagged, ["key", "value"]).groupBy("_g", "principal", "_n", "resource").agg(F.count(F.lit(1)).alias("n")).filter("n = _n").select("principal", "resource")
    free = g.filter("_n = 0").select("principal").distinct()
    return met.unionByName(free.join(resources.select("resource"), F.lit(True))).distinct()


def denied(grants: DataFrame, resources: DataFrame) -> DataFrame:
    """principal and resource, for all principals with grants, of what none of their grants covers."""
    every = grants.select("principal").distinct().join(resources.select("resource").distinct(), F.lit(True))
    return every.join(reachable(grants, resources), ["principal", "resource"], "left_anti")


def problems(tags: DataFrame, resources: DataFrame, grants: DataFrame) -> DataFrame:
    """subject, kind and detail: undefined_tag, undefined_value, missing_tag, grant_undefined_tag, grant_undefined_value."""
    keys = tags.select("key").distinct()
    known = tags.select("key", "value").distinct()
    row = lambda df, kind, detail: df.select(F.col("subject"), F.lit(kind).alias("kind"), detail.alias("detail"))
    has = resources.select(F.col("resource").alias("subject"), F.explode("tags").alias("key", "value"))
    both = F.concat_ws("=", "key", "value")
    undefined = row(has.join(keys, "key", "left_anti"), "undefined_tag", F.col("key"))
    wrong = row(has.join(keys, "key", "left_semi").join(known, ["key", "value"], "left_anti"), "undefined_value", both)
    missing = resources.select(F.col("resource").alias("subject"), "tags").join(keys, F.lit(True)).filter("NOT array_contains(map_keys(tags), key)")
    missing = missing.groupBy("subject").agg(F.array_join(F.array_sort(F.collect_list("key")), ",").alias("key"))
    match = grants.select(F.col("principal").alias("subject"), F.explode("allowed").alias("key", "values")).select("subject", "key", F.explode("values").alias("value"))
    g_undefined = row(match.select("subject", "key").distinct().join(keys, "key", "left_anti"), "grant_undefined_tag", F.col("key"))
    g_wrong = row(match.join(keys, "key", "left_semi").join(known, ["key", "value"], "left_anti"), "grant_undefined_value", both)
    return undefined.unionByName(wrong).unionByName(row(missing, "missing_tag", F.col("key"))).unionByName(g_undefined).unionByName(g_wrong)
