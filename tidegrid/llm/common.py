"""What the text operators share: process-wide caches, checkpoints, checked broadcasts."""

from __future__ import annotations

import functools
import gc
import os
import re
import sys
import tempfile
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The words of the contracts: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: A side of a join is broadcast only below this many estimated bytes.
BROADCAST_BYTES = 8 << 20


def per_process() -> dict:
    """A dict that lives as long as the Python worker, for loaded tokenizers and tables."""
    return sys.modules.setdefault("_tidegrid_cache", types.ModuleType("_tidegrid_cache")).__dict__.setdefault("kept", {})


def given_back() -> None:
    """The memory that this process no longer uses goes back to the system."""
    import ctypes

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)(0)  # glibc has it, other libraries don't


def lean(run):
    """run for mapInArrow or as a function of an iterator, in a worker that waits for further tasks of any operator.

    Before it what another module's tasks have left in per_process() goes, after it the memory that is no longer used.
    """

    @functools.wraps(run)
    def of_task(batches):
        kept = per_process()
        if kept.get("owner") != run.__module__:
            kept.clear()
            kept["owner"] = run.__module__
            given_back()
        try:
            yield from run(batches)
        finally:
            given_back()

    return of_task


def checkpoint_ready(spark: SparkSession) -> None:
    """Takes spark.checkpoint.dir of the session. Where that is unset a local master gets a folder of its own; a cluster must name one."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir names no folder that all executors share")
    sc.setCheckpointDir(folder or os.path.join(tempfile.gettempdir(), "checkpoints"))


def shared_folder(spark: SparkSession) -> str:
    checkpoint_ready(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def saved(df: DataFrame) -> DataFrame:
    """df with its lineage cut: written once as a table in the shared folder and read again, so lost executors don't matter."""
    path = f"{shared_folder(df.sparkSession)}/saved-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def removed(spark: SparkSession, path: str) -> None:
    """Removes a folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Removes tables that saved() wrote and nothing reads any more, and lets Spark drop the shuffles behind them."""
    for df in tables:
        removed(df.sparkSession, df._saved_at)
    let_go(tables[0].sparkSession)


def let_go(spark: SparkSession) -> None:
    """Spark drops the shuffle files of finished steps once the driver has no more use for their plans."""
    gc.collect()
    spark._jvm.System.gc()


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """df marked for broadcast if its counted rows fit BROADCAST_BYTES, else df as it is (a shuffle join then)."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: str) -> str:
    """A-Z to a-z, nothing else."""
    return text.lower() if text.isascii() else re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def splitter(pattern: str):
    """findall of a pre-split pattern that names letters, numbers and white space by their Unicode classes.

    Texts of ASCII and Latin letters alone take the same pattern with these classes spelled out, which is faster.
    """
    import regex

    latin = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
    pattern = pattern.replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}")
    plain = re.compile(rf"[\t\n\r -~{latin}]*").fullmatch
    quick = re.compile(pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s0-9{latin}]").replace(r"\p{L}", f"[{latin}]").replace(r"\p{N}", "[0-9]")).findall
    full = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
    return lambda text: quick(text) if plain(text) else full(text)
