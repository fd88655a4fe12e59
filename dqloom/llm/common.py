"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six characters.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where the session names none and runs in one process (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get()
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="spark-dqloom-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, survives lost executors, can be pruned by column."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, once nothing reads them any more."""
    for df in tables:
        if path := getattr(df, "_written_at", None):
            sc = df.sparkSession.sparkContext
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def release() -> None:
    """For the end of a task: gives what Arrow and Python have freed back to the system, as the worker process lives on."""
    import ctypes
    import gc

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library on Linux
    if trim:
        trim(0)


def freed(work):
    """work on a group of rows, after which ``release`` gives back what it took."""

    def run(pdf):
        out = work(pdf)
        release()
        return out

    return run


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def n_words(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def pow2_at_least(n: int) -> int:
    return 1 << max(0, (int(n) - 1).bit_length())


@contextlib.contextmanager
def batches_of(spark: SparkSession, n: int):
    """Arrow batches of at most n rows meanwhile, for rows that hold whole texts, sets or trees."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_batches(spark: SparkSession, n: int = 500) -> None:
    """Arrow batches of at most n rows from now on, for rows with whole texts that are computed after the function has returned them.

    Spark takes the number when a query starts, so it stays in the session. It changes no result; a smaller one that is set already is kept.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= n:
        spark.conf.set(key, str(n))
