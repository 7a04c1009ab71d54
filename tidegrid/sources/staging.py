"""Tables between steps, in the folder that all executors share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session. Where none is set a local master gets a folder of its own; a cluster must name one."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", "")
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        sc.setCheckpointDir(folder or os.path.join(tempfile.gettempdir(), "checkpoints"))
    return sc._jsc.sc().getCheckpointDir().get()


def staged(df: DataFrame) -> DataFrame:
    """df written once and read again: what several steps use is computed once, and its plan ends here."""
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
