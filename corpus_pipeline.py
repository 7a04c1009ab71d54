"""A corpus pipeline: language ID, quality rules, near-duplicate removal, packing.

Each stage takes what the one before it kept. The first three return the columns of
documents. Null and empty texts, which have no language, go in the first stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import langid, ngram_join, quality_rules
from tidegrid.llm.common import removed, shared_folder
from tidegrid.llm.queries import placed


#: Rows of an Arrow batch at most, and Spark's setting for them. Each task has a batch of texts in the JVM, whose freed buffers stay
#: with it, and one in Python; at Spark's own 10,000 rows these take tens of MB each. No result depends on it.
LOT, LOTS = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_lots(spark: SparkSession) -> None:
    """From now on, since what a stage returns runs later, the session sends LOT rows at a time to Python, or fewer if it already did."""
    if not 0 < int(spark.conf.get(LOTS)) <= LOT:
        spark.conf.set(LOTS, str(LOT))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language; those without letters or between two languages go."""
    small_lots(spark)
    return langid.recognised(docs, langid.fit(docs.filter(~langid.held_out())))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects. Short ones stay, since many that are labelled clean are short."""
    return quality_rules.kept_rows(docs, min_words=1)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (five-word shingles, similarity 0.8)."""
    small_lots(spark)
    return ngram_join.one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_lots(spark)
    return placed(docs)


STAGES = [("language_id", language_id), ("quality_rules", quality), ("ngram_jaccard_join", jaccard_join), ("best_fit_packing", packing)]

#: Learning and packing can't be said in SQL; the stages are tested one by one and as a whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; what a stage kept is written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = spark.conf.get(LOTS)
    try:
        for k, (_, stage) in enumerate(STAGES):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                removed(spark, f"{folder}/{k - 1}")
    finally:
        spark.conf.set(LOTS, before)
    return docs
