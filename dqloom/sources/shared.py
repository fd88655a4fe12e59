"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from dqloom.sources.files import Place


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; one of our own only where the session names none and runs in one process (tests)."""
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
    """df as a Parquet table in the shared folder."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/dq-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` made, once nothing reads them any more."""
    for df in tables:
        if path := getattr(df, "_written_at", None):
            Place(path, df.sparkSession).delete()
