"""Term counts, idf and tf-idf queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..operators import weights as Wt
from ..operators.splits import split_bucket
from .common import SQL_FREQ_LONG, SQL_SENTENCES, SQL_WORD_LONG, rnd, sentences_labelled
from .common import freq_tokens_long, word_tokens_long
from ..functions import tokens as T
from ..operators.tokens import explode_tokens
from ..oracle import sqltext as S

_TF = f"SELECT doc_id, token, count(*) AS tf FROM ({SQL_WORD_LONG}) GROUP BY doc_id, token"
_N = f"SELECT count(*) AS n FROM ({SQL_SENTENCES})"
_IDF = (f"SELECT token, count(*) AS df, ln((1.0 + (SELECT n FROM ({_N}))) / (1.0 + count(*))) + 1.0 AS idf "
        f"FROM ({_TF}) GROUP BY token")


@query("term_counts", f"SELECT doc_id, token, tf FROM ({_TF})")
def q_term_counts(spark, sf):
    return Wt.term_counts(word_tokens_long(spark, sf))


@query("idf", f"SELECT token, df, round(idf, 6) AS idf FROM ({_IDF})")
def q_idf(spark, sf):
    tf = Wt.term_counts(word_tokens_long(spark, sf))
    return Wt.idf(tf, sentences_labelled(spark, sf)).select("token", "df", rnd("idf").alias("idf"))


_TFIDF = (f"SELECT doc_id, token, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS w "
          f"FROM (SELECT t.doc_id, t.token, t.tf, t.tf * i.idf AS w FROM ({_TF}) t JOIN ({_IDF}) i "
          f"ON t.token = i.token)")


@query("tfidf", _TFIDF)
def q_tfidf(spark, sf):
    _, _, w = Wt.fit_transform_tfidf(word_tokens_long(spark, sf), sentences_labelled(spark, sf))
    return w.select("doc_id", "token", "tf", rnd("w").alias("w"))


@query("tf_l2", f"SELECT doc_id, token, tf, round(tf / sqrt(sum(tf * tf) OVER (PARTITION BY doc_id)), 6) AS w "
                f"FROM ({_TF})")
def q_tf_l2(spark, sf):
    tf = Wt.term_counts(word_tokens_long(spark, sf))
    return Wt.tfidf(tf, None).select("doc_id", "token", "tf", rnd("w").alias("w"))


# train / validation by the md5 bucket split (20 % validation)
_SPLIT_SQL = lambda side: (f"SELECT * FROM ({SQL_SENTENCES}) WHERE "  # noqa: E731
                           f"({S.md5_int(42, 'doc_id')} % 100 < 20) = {'true' if side == 'val' else 'false'}")
_TRAIN_LONG = f"SELECT doc_id, unnest({S.word_tokens('text')}) AS token FROM ({_SPLIT_SQL('train')})"
_VAL_LONG = f"SELECT doc_id, unnest({S.word_tokens('text')}) AS token FROM ({_SPLIT_SQL('val')})"
_TRAIN_TF = f"SELECT doc_id, token, count(*) AS tf FROM ({_TRAIN_LONG}) GROUP BY doc_id, token"
_TRAIN_IDF = (f"SELECT token, ln((1.0 + (SELECT count(*) FROM ({_SPLIT_SQL('train')}))) / (1.0 + count(*))) + 1.0 AS idf "
              f"FROM ({_TRAIN_TF}) GROUP BY token")
_VAL_TF = (f"SELECT doc_id, token, count(*) AS tf FROM ({_VAL_LONG}) "
           f"WHERE token IN (SELECT token FROM ({_TRAIN_TF})) GROUP BY doc_id, token")


def _split_tokens(spark, sf):
    docs = sentences_labelled(spark, sf)
    train, val = split_bucket(docs, 0.2, seed=42)
    return (train, explode_tokens(train, T.word_tokens("text"))), (val, explode_tokens(val, T.word_tokens("text")))


@query("term_counts_val", f"SELECT doc_id, token, tf FROM ({_VAL_TF})")
def q_term_counts_val(spark, sf):
    (_, tr_long), (_, va_long) = _split_tokens(spark, sf)
    vocab = tr_long.select("token").distinct()          # the fitted vocabulary as a token set
    return Wt.term_counts_in_vocab(va_long, vocab)


@query("tfidf_val",
       f"SELECT doc_id, token, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS w "
       f"FROM (SELECT t.doc_id, t.token, t.tf, t.tf * i.idf AS w FROM ({_VAL_TF}) t JOIN ({_TRAIN_IDF}) i "
       f"ON t.token = i.token)")
def q_tfidf_val(spark, sf):
    (tr, tr_long), (_, va_long) = _split_tokens(spark, sf)
    train_idf = Wt.idf(Wt.term_counts(tr_long), tr)
    return Wt.tfidf(Wt.term_counts(va_long), train_idf).select("doc_id", "token", "tf", rnd("w").alias("w"))


_FTF = f"SELECT doc_id, token, count(*) AS tf FROM ({SQL_FREQ_LONG}) GROUP BY doc_id, token"


@query("tfidf_log",
       f"SELECT t.doc_id, t.token, t.tf, round((1.0 + ln(t.tf)) * ln(1.0 + (SELECT n FROM ({_N})) / (1.0 + d.df)), 6) AS w "
       f"FROM ({_FTF}) t JOIN (SELECT token, count(*) AS df FROM ({_FTF}) GROUP BY token) d ON t.token = d.token")
def q_tfidf_log(spark, sf):
    tf = Wt.term_counts(freq_tokens_long(spark, sf))
    return Wt.tfidf_log(tf, sentences_labelled(spark, sf)).select("doc_id", "token", "tf", rnd("w").alias("w"))


@query("binarize", f"SELECT doc_id, token, CAST(tf > 1 AS INTEGER) AS bin FROM ({_TF})")
def q_binarize(spark, sf):
    tf = Wt.term_counts(word_tokens_long(spark, sf))
    return Wt.binarize(tf, "tf", 1.0).select("doc_id", "token", "bin")


@query("top_terms",
       f"SELECT doc_id, token, w, rank FROM (SELECT doc_id, token, w, "
       f"row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, token) AS rank FROM ({_TFIDF})) WHERE rank <= 10")
def q_top_terms(spark, sf):
    """Flagship: top 10 tf-idf terms of every labelled document."""
    _, _, w = Wt.fit_transform_tfidf(word_tokens_long(spark, sf), sentences_labelled(spark, sf))
    w = w.withColumn("w", rnd("w"))
    return Wt.top_terms(w, 10).select("doc_id", "token", "w", F.col("rank").cast("bigint").alias("rank"))
