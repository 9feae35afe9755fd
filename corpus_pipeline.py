"""From raw documents to token ids in five stages, each one operator of recordlake.llm.

Every stage takes what its predecessor kept, as Parquet, and all but the last return the
columns of ``documents``. What a stage decides takes effect: rows it rejects are gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordlake.llm.common import stage, table
from recordlake.llm.op1_langid import keep_identified
from recordlake.llm.op2_probminhash import drop_near_copies
from recordlake.llm.op4_containment import drop_leaks
from recordlake.llm.op5_sentencepiece import encode
from recordlake.llm.op10_stream_dedup import drop_copies


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return keep_identified(spark, docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return drop_copies(spark, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return drop_leaks(spark, docs, sf_dir)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding them gives its text back."""
    return encode(spark, docs, ids=True, check=True, without=("text", "n_chars"))


STAGES = [("language_id", language), ("exact_dedup", exact_copies), ("near_dedup", near_copies),
          ("decontamination", decontaminate), ("sentencepiece", tokens)]

#: Several stages can't be written in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
