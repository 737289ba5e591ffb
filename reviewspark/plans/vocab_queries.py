"""Vocabulary, encoding and padding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..functions import arrays as A
from ..functions import tokens as T
from ..functions.fixed import MAX_NB_WORDS, MAX_SEQUENCE_LENGTH, SENTENCE_MAX_LEN
from ..operators import encode as E
from ..operators.tokens import explode_tokens
from ..operators.vocab import vocab_alpha, vocab_first_seen, vocab_freq
from ..session import materialize
from ..sources import tables
from .common import (SQL_CLEAN_LONG, SQL_FREQ_LONG, SQL_REVIEWS, SQL_SENTENCES, SQL_WORD_LONG,
                     clean_tokens_long, freq_tokens_long, reviews_labelled, sentences_labelled,
                     word_tokens_long)
from ..oracle import sqltext as S

NUM_WORDS = 10_000  # fixed value: the cap of the out-of-vocabulary-to-zero encodings

# ---- SQL building blocks ----------------------------------------------------

_SQL_VFREQ = (f"SELECT token, n, row_number() OVER (ORDER BY n DESC, f.d, f.p) AS idx FROM "
              f"(SELECT token, count(*) AS n, min({{'d': doc_id, 'p': pos}}) AS f FROM ({SQL_FREQ_LONG}) GROUP BY token)")
_SQL_VFIRST = (f"SELECT token, row_number() OVER (ORDER BY f.d, f.p) AS idx FROM "
               f"(SELECT token, min({{'d': doc_id, 'p': pos}}) AS f FROM ({SQL_CLEAN_LONG}) GROUP BY token)")
_SQL_VALPHA = f"SELECT token, row_number() OVER (ORDER BY token) - 1 AS idx FROM (SELECT DISTINCT token FROM ({SQL_WORD_LONG}))"


def _sql_encoded(long_sql: str, vocab_sql: str, docs_sql: str, cond: str = "TRUE", oov_zero: bool = False,
                 max_len: int | None = None) -> str:
    """``(doc_id, seq list)`` for every document of ``docs_sql``."""
    pos_cut = f" AND t.pos < {max_len}" if max_len is not None else ""
    if oov_zero:
        body = (f"SELECT t.doc_id, t.pos, coalesce(v.idx, 0) AS idx FROM ({long_sql}) t "
                f"LEFT JOIN (SELECT * FROM ({vocab_sql}) WHERE {cond}) v ON t.token = v.token WHERE TRUE{pos_cut}")
    else:
        body = (f"SELECT t.doc_id, t.pos, v.idx FROM ({long_sql}) t "
                f"JOIN (SELECT * FROM ({vocab_sql}) WHERE {cond}) v ON t.token = v.token WHERE TRUE{pos_cut}")
    return (f"SELECT d.doc_id, coalesce(e.seq, []::BIGINT[]) AS seq FROM (SELECT doc_id FROM ({docs_sql})) d LEFT JOIN "
            f"(SELECT doc_id, list(idx ORDER BY pos) AS seq FROM ({body}) GROUP BY doc_id) e ON d.doc_id = e.doc_id")


def _sql_seq_out(enc_sql: str) -> str:
    return f"SELECT doc_id, CAST(len(seq) AS BIGINT) AS n, array_to_string(seq, ' ') AS seq FROM ({enc_sql})"


def _seq_out(df):
    return df.select("doc_id", F.size("seq").cast("bigint").alias("n"), A.join_ints("seq").alias("seq"))


_SQL_ENC_FREQ = _sql_encoded(SQL_FREQ_LONG, _SQL_VFREQ, SQL_SENTENCES, f"idx < {MAX_NB_WORDS}")
_SQL_ENC_FIRST = _sql_encoded(SQL_CLEAN_LONG, _SQL_VFIRST, SQL_REVIEWS, oov_zero=True, max_len=MAX_SEQUENCE_LENGTH)

# ---- Spark side ---------------------------------------------------------------


def _token_rows(docs, tokens):
    """``(doc_id, tk)`` written once: the vocabulary and the encoding read the same tokens."""
    return materialize(docs.select("doc_id", tokens.alias("tk")), "token-rows")


def _freq_rows(spark, sf):
    rows = _token_rows(sentences_labelled(spark, sf), T.freq_tokens("text"))
    return rows, vocab_freq(explode_tokens(rows, F.col("tk")))


def _enc_freq(spark, sf):
    rows, vocab = _freq_rows(spark, sf)
    return E.encode_drop_oov(rows, F.col("tk"), vocab, cap=MAX_NB_WORDS)


def _enc_first(spark, sf):
    rows = _token_rows(reviews_labelled(spark, sf), T.clean_tokens("text"))
    vocab = materialize(vocab_first_seen(explode_tokens(rows, F.col("tk"))), "vocab-first")
    return E.encode_oov_zero(rows, F.col("tk"), vocab, max_len=MAX_SEQUENCE_LENGTH), vocab


@query("vocab_freq", f"SELECT token, n, idx FROM ({_SQL_VFREQ})")
def q_vocab_freq(spark, sf):
    return vocab_freq(freq_tokens_long(spark, sf))


@query("vocab_first_seen", f"SELECT token, idx FROM ({_SQL_VFIRST})")
def q_vocab_first_seen(spark, sf):
    return vocab_first_seen(clean_tokens_long(spark, sf))


@query("vocab_alpha", f"SELECT token, idx FROM ({_SQL_VALPHA})")
def q_vocab_alpha(spark, sf):
    return vocab_alpha(word_tokens_long(spark, sf))


@query("distinct_tokens", f"SELECT count(DISTINCT token) AS n_tokens FROM ({SQL_WORD_LONG})")
def q_distinct_tokens(spark, sf):
    return word_tokens_long(spark, sf).select(F.countDistinct("token").alias("n_tokens"))


@query("encode_freq", _sql_seq_out(_SQL_ENC_FREQ))
def q_encode_freq(spark, sf):
    """Frequency vocabulary capped at 20000 (indices 1..19999); unknown words dropped."""
    return _seq_out(_enc_freq(spark, sf))


@query("encode_oov_zero", _sql_seq_out(_sql_encoded(SQL_FREQ_LONG, _SQL_VFREQ, SQL_SENTENCES, f"idx < {NUM_WORDS}",
                                                    oov_zero=True, max_len=MAX_SEQUENCE_LENGTH)))
def q_encode_oov_zero(spark, sf):
    """Top 9999 words kept, every other word -> 0 in place; first 1000 positions."""
    rows, vocab = _freq_rows(spark, sf)
    return _seq_out(E.encode_oov_zero(rows, F.col("tk"), vocab, keep_below=NUM_WORDS, max_len=MAX_SEQUENCE_LENGTH))


@query("encode_skip_top", _sql_seq_out(_sql_encoded(SQL_FREQ_LONG, _SQL_VFREQ, SQL_SENTENCES,
                                                    f"idx < {NUM_WORDS} AND idx > 20", oov_zero=True)))
def q_encode_skip_top(spark, sf):
    """The 20 most frequent words and words beyond the top 9999 -> 0."""
    rows, vocab = _freq_rows(spark, sf)
    return _seq_out(E.encode_oov_zero(rows, F.col("tk"), vocab, keep_below=NUM_WORDS, skip_top=20))


@query("encode_first_seen", _sql_seq_out(_SQL_ENC_FIRST))
def q_encode_first_seen(spark, sf):
    """First-seen vocabulary of the cleaned review tokens; first 1000 words."""
    enc, _ = _enc_first(spark, sf)
    return _seq_out(enc)


@query("pad_pre",
       f"SELECT doc_id, array_to_string(list_reverse(list_resize(list_reverse(seq), {SENTENCE_MAX_LEN}, 0)), ' ') AS padded "
       f"FROM ({_SQL_ENC_FREQ})")
def q_pad_pre(spark, sf):
    return _enc_freq(spark, sf).select("doc_id", A.join_ints(A.pad_pre("seq", SENTENCE_MAX_LEN)).alias("padded"))


@query("pad_post",
       f"SELECT doc_id, array_to_string(list_resize(seq, {MAX_SEQUENCE_LENGTH}, 0), ' ') AS padded FROM ({_SQL_ENC_FIRST})")
def q_pad_post(spark, sf):
    enc, _ = _enc_first(spark, sf)
    return enc.select("doc_id", A.join_ints(A.pad_post("seq", MAX_SEQUENCE_LENGTH)).alias("padded"))


@query("pad_longest",
       f"SELECT doc_id, array_to_string(list_resize(seq, (SELECT max(len(seq)) FROM ({_SQL_ENC_FREQ})), 0), ' ') AS padded "
       f"FROM ({_SQL_ENC_FREQ})")
def q_pad_longest(spark, sf):
    enc = _enc_freq(spark, sf)
    padded = enc.select("doc_id", A.pad_post_to("seq", E.max_length(enc)).alias("p"))
    return padded.select("doc_id", A.join_ints("p").alias("padded"))


@query("one_hot",
       "SELECT l.doc_id, CASE WHEN l.quality = 0 THEN '1 0' ELSE '0 1' END AS onehot, l.quality AS label_back "
       "FROM labels l")
def q_one_hot(spark, sf):
    lab = tables.table(spark, sf, "labels", "doc_id", "quality")
    oh = lab.select("doc_id", A.one_hot("quality", 2).alias("oh"))
    return oh.select("doc_id", A.join_ints("oh").alias("onehot"), A.one_hot_column("oh", 1).alias("label_back"))


@query("decode",
       f"SELECT e.doc_id, coalesce(string_agg(v.token, ' ' ORDER BY e.pos), '') AS text FROM "
       f"(SELECT d.doc_id, u.pos, u.idx FROM ({_SQL_ENC_FIRST}) d LEFT JOIN "
       f"(SELECT doc_id, unnest(seq) AS idx, generate_subscripts(seq, 1) AS pos FROM ({_SQL_ENC_FIRST})) u "
       f"ON d.doc_id = u.doc_id) e LEFT JOIN ({_SQL_VFIRST}) v ON e.idx = v.idx GROUP BY e.doc_id")
def q_decode(spark, sf):
    enc, vocab = _enc_first(spark, sf)
    return E.decode(enc, vocab)
