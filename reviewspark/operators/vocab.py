"""Vocabularies: token -> dense index tables.

All three are an aggregation by token (partial aggregation absorbs hot
tokens) followed by a distributed global rank (``ranking.dense_index``), so
no step puts the whole vocabulary into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import dense_index


def _token_stats(tokens_long: DataFrame, doc_order: str = "doc_id") -> DataFrame:
    return (tokens_long.groupBy("token")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.min(F.struct(F.col(doc_order).alias("d"), F.col("pos").alias("p"))).alias("first"))
            .select("token", "n", F.col("first.d").alias("first_doc"),
                    F.col("first.p").alias("first_pos")))


def vocab_freq(tokens_long: DataFrame, doc_order: str = "doc_id") -> DataFrame:
    """Index 1..n by count descending, ties by first occurrence (doc order, position).

    Output ``(token, n, idx)``.
    """
    stats = _token_stats(tokens_long, doc_order)
    return dense_index(stats, [F.desc("n"), F.asc("first_doc"), F.asc("first_pos")]) \
        .select("token", "n", "idx")


def vocab_first_seen(tokens_long: DataFrame, doc_order: str = "doc_id") -> DataFrame:
    """Index 1..n by first occurrence in (doc order, position). ``(token, idx)``.

    ``doc_order`` names the column giving the document order (``doc_id`` or a
    shuffle rank)."""
    stats = _token_stats(tokens_long, doc_order)
    return dense_index(stats, [F.asc("first_doc"), F.asc("first_pos")]).select("token", "idx")


def vocab_alpha(tokens_long: DataFrame) -> DataFrame:
    """Alphabetical, 0-based. ``(token, idx)``."""
    distinct = tokens_long.select("token").distinct()
    return dense_index(distinct, [F.asc("token")], start=0).select("token", "idx")


def capped(vocab: DataFrame, cap: int) -> DataFrame:
    """Keep indices ``< cap`` (a cap of 20000 keeps 1..19999)."""
    return vocab.where(F.col("idx") < cap)


def skip_top(vocab: DataFrame, n: int) -> DataFrame:
    """Drop the ``n`` most frequent words (a crude stop list)."""
    return vocab.where(F.col("idx") > n)
