"""What the stages of the pipeline hold in Python workers and Arrow buffers."""

import pandas as pd
import pytest
from dqloom.llm import language_id, mixing, ngram_join, packing
from pyspark.sql import functions as F

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture
def usual_batches(spark):
    before = spark.conf.get(KEY)
    spark.conf.set(KEY, "10000")
    yield
    spark.conf.set(KEY, before)


@pytest.mark.parametrize("stage", [language_id.keep_identified, packing.packed_texts])
def test_whole_texts_go_to_python_in_small_batches(spark, sf, usual_batches, stage):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stage(docs)  # computed by the caller, later
    size = F.pandas_udf(lambda s: pd.Series([len(s)] * len(s)), "long")
    assert spark.range(0, 3000, 1, 1).select(size("id").alias("n")).agg(F.max("n")).first()[0] <= 500


def test_a_smaller_number_of_rows_is_kept(spark, sf, usual_batches):
    spark.conf.set(KEY, "7")
    language_id.keep_identified(spark.read.parquet(f"{sf}/documents.parquet"))
    assert spark.conf.get(KEY) == "7"


def test_mixing_starts_no_second_kind_of_workers(spark, sf, monkeypatch):
    def refused(*args, **more):
        raise AssertionError("rows through a Python RDD")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refused)
    assert mixing.mix(spark.read.parquet(f"{sf}/documents.parquet")).count() > 0


def test_groups_give_memory_back(monkeypatch):
    from dqloom.llm import common

    calls = []
    monkeypatch.setattr(common, "release", lambda: calls.append(1))
    part = pd.DataFrame([(0, 0, 0, b"", b"", b"", b"", b"", b"", b"")], columns=[c.split()[0] for c in ngram_join._SCAN.split(", ")])
    assert len(common.freed(ngram_join._counted)(part)) == 1 and calls
