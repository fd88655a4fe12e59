"""A corpus from raw documents to packed sequences, in five stages; each stage's rows are written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dqloom.llm.common import discard, table, written
from dqloom.llm.exact_dedup import drop_copies
from dqloom.llm.language_id import keep_identified
from dqloom.llm.mixing import mix
from dqloom.llm.ngram_join import one_of_each
from dqloom.llm.packing import packed_texts


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin.

    A null text, one without letters and one between two languages go; if nothing could be learned, all go. Very long texts are compressed whole;
    of languages that tie, the one with more training rows is told; rows that repeat are each judged; an empty table stays empty; further
    columns, whatever their names, are carried.
    """
    return keep_identified(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each text, but for white space: the longest, then that of the smallest id.

    A null text counts as empty, and one empty text stays; a null id comes last; rows that repeat id and text, or tie in length, leave exactly one;
    very long texts are hashed whole; an empty table stays empty; further columns, whatever their names, are carried.
    """
    return drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each group of similar ones, that of the smallest id.

    Null and empty texts stay, each for itself; very long texts are compared whole; rows of one id and different texts are different documents; rows
    without an id come last, then by a hash of the text; rows that repeat id and text stay or go together; an empty table stays empty;
    further columns, whatever their names, are carried.
    """
    return one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to three times.

    Documents without words are never taken; a null source is a source; rows without an id of their own are told apart by text, then by place; which of
    documents of one length are taken follows a seeded hash; a very long text counts with all its words; an empty table stays empty;
    further columns, whatever their names, are carried.
    """
    return mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in a sequence and their part of the text.

    A document without words is one piece without a bin; a null source or id is one like others; rows that repeat are copies with numbers of their
    own, never in one bin; a very long text gives full pieces and a rest; pieces that tie in size go by cluster, source, id and copy; an
    empty table gives no pieces; further columns are left out, whatever their names.
    """
    return packed_texts(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("ngram_join", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL expresses neither the language models nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(before)  # nothing reads a stage's rows once the next stage's are written
    return STAGES[-1][1](spark, docs, sf_dir)
