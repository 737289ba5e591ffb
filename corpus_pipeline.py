"""The corpus pipeline: toxicity, exact dedup, MinHash near-dedup, mixing, byte-level BPE.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``.  All but the last return the columns of
``documents``.  Every stage works on all rows it is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewspark.llm import bpe, exact_dedup, mixing, near_dup, toxicity
from reviewspark.llm.common import bounded_batches, materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; the model is fitted on the labelled training rows among ``docs``."""
    bounded_batches(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return near_dup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as the mix takes it (0, 1 or 2 times)."""
    bounded_batches(spark)
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return bpe.round_trip(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact), ("near_dedup", drop_near),
          ("mixing", mix_sources), ("byte_bpe", tokenize)]

# the fitted model, the sketches and the tokenizer are not SQL: tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
