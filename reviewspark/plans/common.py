"""Shared inputs of the registered queries (Spark side and SQL side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import tokens as T
from ..oracle import sqltext as S
from ..operators.tokens import explode_tokens
from ..sources import tables

# ---- Spark side -----------------------------------------------------------


def sentences_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled texts after the sentence normaliser: ``(doc_id, text, label)``."""
    lab = tables.labelled_documents(spark, sf)
    return lab.select("doc_id", C.clean_sentence("text").alias("text"), "label")


def reviews_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled texts after the review cleaner: ``(doc_id, text, label)``."""
    lab = tables.labelled_documents(spark, sf)
    return lab.select("doc_id", C.clean_review("text").alias("text"), "label")


def word_tokens_long(spark: SparkSession, sf: str) -> DataFrame:
    """Count-vectoriser tokens of the cleaned labelled sentences."""
    return explode_tokens(sentences_labelled(spark, sf), T.word_tokens("text"))


def freq_tokens_long(spark: SparkSession, sf: str) -> DataFrame:
    return explode_tokens(sentences_labelled(spark, sf), T.freq_tokens("text"))


def clean_tokens_long(spark: SparkSession, sf: str, stops=True) -> DataFrame:
    from ..functions.fixed import STOP_WORDS
    return explode_tokens(reviews_labelled(spark, sf), T.clean_tokens("text", STOP_WORDS if stops else ()))


def rnd(c, n: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


# ---- SQL side ---------------------------------------------------------------

LABELLED = ("SELECT d.doc_id, d.text, CAST(l.quality AS INTEGER) AS label "
            "FROM documents d JOIN labels l ON d.doc_id = l.doc_id")

SQL_SENTENCES = f"SELECT doc_id, {S.clean_sentence('text')} AS text, label FROM ({LABELLED})"
SQL_REVIEWS = (f"SELECT doc_id, {S.keep_rule(S.strip_html('text'))} AS text, label "
               f"FROM ({LABELLED})")


def sql_long(src_sql: str, tokens_expr: str, key: str = "doc_id") -> str:
    """``(key, pos, token)`` from a source query and a list expression over its ``text``."""
    return (f"SELECT {key}, unnest(tk) AS token, generate_subscripts(tk, 1) - 1 AS pos "
            f"FROM (SELECT {key}, {tokens_expr} AS tk FROM ({src_sql}))")


SQL_WORD_LONG = sql_long(SQL_SENTENCES, S.word_tokens("text"))
SQL_FREQ_LONG = sql_long(SQL_SENTENCES, S.freq_tokens("text"))
SQL_CLEAN_LONG = sql_long(SQL_REVIEWS, S.clean_tokens("text"))


# ---- scored documents for the evaluation queries ---------------------------
# A deterministic stand-in for a model's probability: informative about the
# label but noisy, identical in both engines (md5 draws, IEEE doubles).


def scored_labelled(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.hashing import md5_unit
    lab = sentences_labelled(spark, sf)
    pred = F.lit(0.3) * F.col("label") + F.lit(0.7) * md5_unit("score", "doc_id")
    return lab.withColumn("pred", pred)


SQL_SCORED = (f"SELECT doc_id, text, label, CAST(0.3 AS DOUBLE) * label + CAST(0.7 AS DOUBLE) * "
              f"{S.md5_unit('score', 'doc_id')} AS pred FROM ({SQL_SENTENCES})")
