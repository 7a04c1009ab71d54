"""Contiguous shards of near-equal bytes by global prefix sums.

Rows in doc_id order are dealt to ranges; the bytes and rows of each range give,
summed over the ranges before it, where its rows begin in the whole. A row whose
middle byte lies in the k-th of n equal parts of all bytes goes to shard k. Texts
are measured where they are read; only ids, sizes and checksums are shuffled.

Defined results: a null text has 0 bytes besides the fixed 8 and checksum 0; rows
that agree in all columns come in reading order; a null doc_id comes first; an empty
table gives an empty result; one row larger than a shard's part has the shards
around it stay smaller or empty. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import saved, shuffle_partitions

#: Bytes that a row counts for besides its text.
ROW_BYTES = 8


def measured(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
    ).withColumn("_nth", F.monotonically_increasing_id())


def balanced_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard) of every row of docs."""
    spark = docs.sparkSession
    order = ["doc_id", "text_crc32", "size", "_nth"]
    ranged = saved(measured(docs).repartitionByRange(shuffle_partitions(spark), *order).withColumn("_range", F.spark_partition_id()))
    # One row for each range from here on: their number is a setting, not the data's.
    totals = ranged.groupBy("_range").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy("_range")
    totals = totals.select(
        "_range",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(whole).alias("_total"),
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    to_here = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = (
        ranged.withColumn("_to", to_here).withColumn("_k", F.row_number().over(inside)).join(F.broadcast(totals), "_range")
        # Twice the middle byte, so that halves stay whole numbers; decimals since bytes times shards may pass 63 bits.
        .withColumn("_mid", (F.lit(2) * (F.col("_bytes_before") + F.col("_to")) - F.col("size")).cast("decimal(38,0)"))
        .withColumn("shard", F.expr(f"cast(least({shards - 1}, _mid * {shards} div (2 * cast(_total as decimal(20,0)))) as int)"))
        .withColumn("_row", F.col("_rows_before") + F.col("_k") - 1)
        .select("doc_id", "size", "text_crc32", "shard", "_row")
    )
    # The first row of a shard: one row for each shard.
    starts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))
    return placed.join(F.broadcast(starts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot"))
