"""Term counts, document frequency, tf-idf (long form ``(doc_id, token, ...)``).

Plan shape (see ``explain``): explode is row-local; ``groupBy(doc_id, token)``
is fully combined map-side because one document's tokens come from one input
row; document frequency is a partial+final aggregate by token; the document
count ``N`` is a scalar subquery (computed once, no join); joins of
term counts with per-token tables split the hot tokens off
(``joins.skew_split_join``) and read written tables, so a text is tokenised
once; the L2 norm is a window per document, bounded by the distinct terms of
one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def term_counts(tokens_long: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(doc_id, token, tf)`` with ``tf`` bigint."""
    return tokens_long.groupBy(key, "token").agg(F.count(F.lit(1)).alias("tf"))


def split_join(tf: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """Join written term counts with a written per-token table.

    A table measured to be small is broadcast, so the counts do not move; beyond that hot tokens are joined apart
    (``joins.skew_split_join``), by token counts that are written once.
    """
    from ..session import materialize
    from .joins import fits, skew_split_join
    if fits(table):
        return tf.join(F.broadcast(table), "token", how)
    counts = materialize(tf.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token-counts")
    return skew_split_join(tf, table, "token", counts, how=how)


def term_counts_in_vocab(tokens_long: DataFrame, vocab: DataFrame, key: str = "doc_id") -> DataFrame:
    """Term counts against a fitted vocabulary; tokens outside it are ignored.

    Counted first (one row per document and token), then joined: never a raw token row per occurrence.
    """
    from ..session import materialize
    tf = materialize(term_counts(tokens_long, key), "tf-val")
    return split_join(tf, materialize(vocab.select("token"), "token-set"), "left_semi")


def n_docs(docs: DataFrame) -> Column:
    """Number of documents (including ones without tokens) as a scalar subquery."""
    return docs.select(F.count(F.lit(1))).scalar()


def idf(tf: DataFrame, docs: DataFrame) -> DataFrame:
    """``(token, df, idf)``; smooth idf ``ln((1+N)/(1+df)) + 1``."""
    n = n_docs(docs)
    return (tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
              .select("token", "df",
                      (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf")))


def _l2(df: DataFrame, w: str, key: str) -> DataFrame:
    norm = F.sqrt(F.sum(F.col(w) * F.col(w)).over(Window.partitionBy(key)))
    return df.withColumn(w, F.when(norm > 0, F.col(w) / norm).otherwise(F.lit(0.0)))


def tfidf(tf: DataFrame, idf_table: DataFrame | None, key: str = "doc_id") -> DataFrame:
    """``(doc_id, token, tf, w)``: tf x idf, L2-normalised per document.

    With ``idf_table=None`` this is the ``use_idf=False`` variant (tf / ||tf||).
    Passing a training idf table to validation term counts applies the
    training weights; unseen tokens drop out (inner join).
    """
    if idf_table is None:
        raw = tf.withColumn("w", F.col("tf").cast("double"))
    else:
        from ..session import materialize
        tf = materialize(tf, "tf")
        idf_table = materialize(idf_table.select("token", "idf"), "idf")
        raw = split_join(tf, idf_table).withColumn("w", F.col("tf") * F.col("idf")).drop("idf")
    return _l2(raw.select(key, "token", "tf", "w"), "w", key)


def tfidf_log(tf: DataFrame, docs: DataFrame) -> DataFrame:
    """Log-scaled tf-idf of the frequency tokeniser's matrix mode:
    ``(1 + ln tf) * ln(1 + N / (1 + df))``, not normalised."""
    from ..session import materialize
    n = n_docs(docs)
    tf = materialize(tf, "tf")  # read twice: the texts are tokenised once
    df_t = materialize(tf.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "df")
    return (split_join(tf, df_t)
              .select("doc_id", "token", "tf",
                      ((F.lit(1.0) + F.log(F.col("tf"))) *
                       F.log(F.lit(1.0) + n / (F.lit(1.0) + F.col("df")))).alias("w")))


def fit_transform_tfidf(tokens_long: DataFrame, docs: DataFrame, key: str = "doc_id"):
    """``(tf, idf, weights)`` with the term counts written once.

    The term counts feed both the document frequencies and the weighting
    join; AQE does not reliably reuse that exchange, and recomputing it
    would re-run the cleaning and tokenising of every text.  They are
    therefore materialised in the shared checkpoint folder (one pass, lineage
    cut, survives executor loss) and read twice.
    """
    from ..session import materialize
    tf = materialize(term_counts(tokens_long, key), "tf")
    idf_table = materialize(idf(tf, docs), "idf")
    raw = (split_join(tf, idf_table.select("token", "idf"))
           .withColumn("w", F.col("tf") * F.col("idf")).drop("idf"))
    return tf, idf_table, _l2(raw.select(key, "token", "tf", "w"), "w", key)


def binarize(df: DataFrame, col: str, threshold: float = 0.0, name: str = "bin") -> DataFrame:
    """``(col > threshold) -> 1 else 0``."""
    return df.withColumn(name, (F.col(col) > threshold).cast("int"))


def top_terms(weights: DataFrame, k: int = 10, key: str = "doc_id") -> DataFrame:
    """Top ``k`` terms per document by weight (ties by token)."""
    w = Window.partitionBy(key).orderBy(F.desc("w"), F.asc("token"))
    return weights.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
