"""Token tables: the long form ``(doc_id, pos, token)`` and friends.

Exploding is row-local (no shuffle); every later per-token aggregate uses
map-side partial aggregation, so a hot token (``the``) is combined before the
shuffle rather than sent row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tokens as T


def explode_tokens(df: DataFrame, tokens: Column, key: str = "doc_id") -> DataFrame:
    """``(key, pos, token)`` with 0-based positions."""
    return df.select(key, F.posexplode(tokens).alias("pos", "token"))


def sentence_corpus(df: DataFrame, text: str = "text", key: str = "doc_id",
                    remove_stop_words: bool = False, ascii_fold: bool = True,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents to ``(doc_id, sent_no, words)``: one row per sentence, never one
    giant list.  Optional ASCII fold first (undecodable text dropped)."""
    from ..functions.clean import ascii_only
    src = ascii_only(F.col(text)) if ascii_fold else F.col(text)
    return df.select(key, *keep, F.posexplode(T.sentence_words(src, remove_stop_words)).alias("sent_no", "words"))


def corpus_union(*corpora: DataFrame) -> DataFrame:
    """UNION ALL of corpora; missing columns become null (e.g. ``label``)."""
    out = corpora[0]
    for c in corpora[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out


def ngram_table(df: DataFrame, tokens: Column, lo: int, hi: int, key: str = "doc_id") -> DataFrame:
    """``(key, gram)`` for all n-grams with n in [lo, hi].

    The token array is projected first: the n-gram lambdas refer to it once
    per position, and a lambda body gets no common-subexpression reuse, so an
    inline tokeniser would be re-run for every n-gram."""
    return (df.select(key, tokens.alias("_t"))
              .select(key, F.explode(T.ngram_range(F.col("_t"), lo, hi)).alias("gram")))
