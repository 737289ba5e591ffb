"""Sampling and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..functions import arrays as A
from ..operators import splits as Sp
from ..oracle import sqltext as S
from ..sources import tables
from .common import LABELLED, SQL_REVIEWS
from .prepare import prepare_train_val

_ORDER = f"{S.md5_key(42, 'doc_id')}, doc_id"


@query("split_bucket",
       f"SELECT doc_id, CASE WHEN {S.md5_int(42, 'doc_id')} % 100 < 20 THEN 'val' ELSE 'train' END AS split FROM documents")
def q_split_bucket(spark, sf):
    return Sp.with_split_bucket(tables.documents(spark, sf, "doc_id"), 0.2, 42).select("doc_id", "split")


@query("split_complement",
       f"SELECT doc_id FROM documents WHERE doc_id NOT IN "
       f"(SELECT doc_id FROM documents WHERE {S.md5_int(42, 'doc_id')} % 100 < 20)")
def q_split_complement(spark, sf):
    docs = tables.documents(spark, sf, "doc_id")
    _, val = Sp.split_bucket(docs, 0.2, 42)
    return Sp.split_complement(docs, val)


@query("split_exact",
       f"SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {_ORDER}) <= round_even(0.2 * (SELECT count(*) FROM documents), 0) "
       f"THEN 'val' ELSE 'train' END AS split FROM documents")
def q_split_exact(spark, sf):
    return Sp.with_split_exact(tables.documents(spark, sf, "doc_id"), 0.2, 42).select("doc_id", "split")


@query("split_tail",
       f"SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {_ORDER}) > "
       f"(SELECT count(*) - floor(0.2 * count(*)) FROM documents) THEN 'val' ELSE 'train' END AS split FROM documents")
def q_split_tail(spark, sf):
    return Sp.with_split_tail(tables.documents(spark, sf, "doc_id"), 0.2, 42).select("doc_id", "split")


@query("split_tail_ordered",
       "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= (SELECT floor(count(*) * 0.8) FROM documents) "
       "THEN 'train' ELSE 'val' END AS split FROM documents")
def q_split_tail_ordered(spark, sf):
    return Sp.with_split_tail_ordered(tables.documents(spark, sf, "doc_id"), 0.2).select("doc_id", "split")


@query("downsample", f"SELECT doc_id FROM documents ORDER BY {_ORDER} LIMIT 100")
def q_downsample(spark, sf):
    """Seeded shuffle and head 100 (the limit is the operator)."""
    return Sp.downsample(tables.documents(spark, sf, "doc_id"), 100, 42)


@query("stratified_folds",
       f"SELECT doc_id, label, CAST((row_number() OVER (ORDER BY label, {_ORDER}) - 1) % 3 AS INTEGER) AS fold "
       f"FROM ({LABELLED})")
def q_stratified_folds(spark, sf):
    lab = tables.labelled_documents(spark, sf).select("doc_id", "label")
    return Sp.with_folds(lab, 3, 42).select("doc_id", "label", "fold")


_PTV_TOKENS = S.clean_tokens("text")
_PTV_SQL = (
    f"WITH r AS (SELECT doc_id, text, label, row_number() OVER (ORDER BY {_ORDER}) AS rank FROM ({SQL_REVIEWS})), "
    f"s AS (SELECT * FROM r WHERE rank <= 1000), "
    f"n AS (SELECT count(*) AS n FROM s), "
    f"t AS (SELECT doc_id, rank, unnest(tk) AS token, generate_subscripts(tk, 1) - 1 AS pos "
    f"      FROM (SELECT doc_id, rank, {_PTV_TOKENS} AS tk FROM s)), "
    f"v AS (SELECT token, row_number() OVER (ORDER BY f.d, f.p) AS idx FROM "
    f"      (SELECT token, min({{'d': rank, 'p': pos}}) AS f FROM t GROUP BY token)), "
    f"e AS (SELECT t.doc_id, list(coalesce(v.idx, 0) ORDER BY t.pos) AS seq FROM t LEFT JOIN v ON t.token = v.token "
    f"      WHERE t.pos < 1000 GROUP BY t.doc_id) "
    f"SELECT s.doc_id, s.rank, CASE WHEN s.rank > n.n - floor(0.2 * n.n) THEN 'val' ELSE 'train' END AS split, s.label, "
    f"CASE WHEN s.label = 0 THEN '1 0' ELSE '0 1' END AS onehot, "
    f"array_to_string(list_resize(coalesce(e.seq, []::BIGINT[]), 1000, 0), ' ') AS x "
    f"FROM s CROSS JOIN n LEFT JOIN e ON s.doc_id = e.doc_id")


@query("prepare_train_val", _PTV_SQL)
def q_prepare_train_val(spark, sf):
    """Shuffle (seed 42), keep 1000, first-seen vocabulary on the sample, encode
    1000 words, post-pad, one-hot label, last 20 % validate."""
    out, _ = prepare_train_val(tables.labelled_documents(spark, sf))
    return out.select("doc_id", "rank", "split", "label", A.join_ints("onehot").alias("onehot"),
                      A.join_ints("x").alias("x"))
