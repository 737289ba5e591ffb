"""Word-vector queries: embedding matrix, known tokens, document vectors,
neighbours, subsampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..functions import tokens as T
from ..operators import vectors as V
from ..operators.tokens import explode_tokens
from ..operators.vocab import vocab_first_seen
from ..oracle import sqltext as S
from ..session import materialize
from ..sources import tables
from ..sources.vectors import SQL_BOUND_VECTORS, bound_vectors
from .common import LABELLED, SQL_CLEAN_LONG, reviews_labelled, rnd

DIM = 64

_SQL_VFIRST = (f"SELECT token, row_number() OVER (ORDER BY f.d, f.p) AS idx FROM "
               f"(SELECT token, min({{'d': doc_id, 'p': pos}}) AS f FROM ({SQL_CLEAN_LONG}) GROUP BY token)")
_SQL_WORDS_LONG = (f"SELECT doc_id, unnest(tk) AS token, generate_subscripts(tk, 1) - 1 AS pos FROM "
                   f"(SELECT doc_id, {S.review_words('text')} AS tk FROM ({LABELLED}))")


def _words_long(spark, sf):
    return explode_tokens(tables.labelled_documents(spark, sf), T.review_words("text"))


def _vsum(c):
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


@query("embedding_matrix",
       f"SELECT r.idx, CAST(coalesce(len(v.vec), {DIM}) AS BIGINT) AS dim, "
       f"round(coalesce(list_sum(list_transform(v.vec, lambda x: CAST(x AS DOUBLE))), 0.0), 6) AS vsum "
       f"FROM (SELECT token, idx FROM ({_SQL_VFIRST}) UNION ALL SELECT NULL, 0) r "
       f"LEFT JOIN ({SQL_BOUND_VECTORS}) v ON r.token = v.token")
def q_embedding_matrix(spark, sf):
    """First-seen vocabulary rows plus row 0, each with its vector or zeros."""
    docs = reviews_labelled(spark, sf)
    vocab = vocab_first_seen(explode_tokens(docs, T.clean_tokens("text")))
    m = V.embedding_matrix(vocab, bound_vectors(spark, sf), DIM)
    return m.select("idx", F.size("vec").cast("bigint").alias("dim"), rnd(_vsum(F.col("vec"))).alias("vsum"))


@query("tokens_in_vocab",
       f"SELECT t.doc_id, t.pos, t.token FROM ({_SQL_WORDS_LONG}) t WHERE t.token IN (SELECT token FROM ({SQL_BOUND_VECTORS}))")
def q_tokens_in_vocab(spark, sf):
    return V.tokens_with_vectors(_words_long(spark, sf), bound_vectors(spark, sf)) \
            .select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token")


@query("doc_vectors",
       f"SELECT l.doc_id, coalesce(m.dim, -1) AS dim, coalesce(m.value, 0.0) AS value FROM labels l JOIN documents USING (doc_id) LEFT JOIN ("
       f"SELECT doc_id, dim, round(avg(x), 6) AS value FROM ("
       f"SELECT t.doc_id, unnest(generate_series(0, len(v.vec) - 1)) AS dim, unnest(list_transform(v.vec, lambda y: CAST(y AS DOUBLE))) AS x "
       f"FROM ({_SQL_WORDS_LONG}) t JOIN ({SQL_BOUND_VECTORS}) v ON t.token = v.token) GROUP BY doc_id, dim) m ON l.doc_id = m.doc_id")
def q_doc_vectors(spark, sf):
    """Mean word vector per labelled document, long form ``(doc_id, dim, value)``; a document without any known
    word has a null vector: one row, ``dim`` -1."""
    docs = tables.table(spark, sf, "documents", "doc_id").join(tables.table(spark, sf, "labels", "doc_id"), "doc_id")
    dv = V.doc_vectors(_words_long(spark, sf), bound_vectors(spark, sf), docs=docs)
    return dv.select("doc_id", F.posexplode_outer("vec").alias("dim", "value")) \
             .select("doc_id", F.coalesce(F.col("dim").cast("bigint"), F.lit(-1)).alias("dim"),
                     F.coalesce(rnd("value"), F.lit(0.0)).alias("value"))


_COS = ("list_sum(list_transform(range(1, len(e.embedding) + 1), lambda i: CAST(e.embedding[i] AS DOUBLE) * CAST(q.v[i] AS DOUBLE)))"
        " / (sqrt(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))"
        " * sqrt(list_sum(list_transform(q.v, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))))")


@query("most_similar",
       f"SELECT vec_id, round(cos, 6) AS cos FROM (SELECT e.vec_id, {_COS} AS cos FROM embeddings e, "
       f"(SELECT embedding AS v FROM embeddings WHERE vec_id = 0) q WHERE e.vec_id <> 0) ORDER BY cos DESC, vec_id LIMIT 10")
def q_most_similar(spark, sf):
    """10 nearest vectors to vector 0 by cosine (top-k is the operator)."""
    emb = tables.table(spark, sf, "embeddings", "vec_id", "embedding")
    q = emb.where(F.col("vec_id") == 0).select("embedding").scalar()
    top = V.most_similar(emb, q, 10, exclude=0)
    return top.select("vec_id", rnd("cos").alias("cos"))


@query("subsample_words",
       f"WITH t AS ({_SQL_WORDS_LONG}), c AS (SELECT token, count(*) AS c FROM t GROUP BY token), "
       f"tot AS (SELECT count(*) AS n FROM t) "
       f"SELECT t.doc_id, t.pos, t.token FROM t JOIN c ON t.token = c.token CROSS JOIN tot "
       f"WHERE (CAST(('0x' || substr(md5('8:' || CAST(t.doc_id AS VARCHAR) || ':' || CAST(t.pos AS VARCHAR)), 1, 8))::BIGINT AS DOUBLE) "
       f"/ CAST(4294967296 AS DOUBLE)) < least(1.0, (sqrt((CAST(c.c AS DOUBLE) / CAST(tot.n AS DOUBLE)) / 0.001) + 1.0) * 0.001 "
       f"/ (CAST(c.c AS DOUBLE) / CAST(tot.n AS DOUBLE)))")
def q_subsample_words(spark, sf):
    """Frequent-word downsampling (t = 1e-3, seed 8) of the labelled review words."""
    docs = materialize(tables.labelled_documents(spark, sf).select("doc_id", T.review_words("text").alias("words")), "review-words")
    kept = V.subsample_arrays(docs, "words", ("doc_id",), 1e-3, 8)
    return (kept.select("doc_id", F.explode("words").alias("w"))
            .select("doc_id", F.col("w.pos").cast("bigint").alias("pos"), "w.token"))
