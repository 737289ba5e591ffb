"""Evaluation queries over a deterministic score column (see
``common.scored_labelled``) so each has an exact SQL twin; the model queries
feed the same operators with real predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..functions import tokens as T
from ..functions.hashing import md5_bucket
from ..operators import evaluate as Ev
from ..operators import sketches as Sk
from ..oracle import sqltext as S
from ..session import shared_path
from .common import SQL_SCORED, SQL_SENTENCES, rnd, scored_labelled, sentences_labelled


@query("describe_words",
       f"SELECT count(n) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, "
       f"CAST(min(n) AS DOUBLE) AS min, round(quantile_cont(n, 0.25), 6) AS p25, round(quantile_cont(n, 0.5), 6) AS p50, "
       f"round(quantile_cont(n, 0.75), 6) AS p75, CAST(max(n) AS DOUBLE) AS max "
       f"FROM (SELECT len({S.ws_split('text')}) AS n FROM ({SQL_SENTENCES}))")
def q_describe_words(spark, sf):
    """Words per cleaned labelled document: the 8-number summary."""
    n = sentences_labelled(spark, sf).select(T.word_count("text").alias("n"))
    d = Ev.describe(n, "n")
    return d.select("count", *[rnd(c).alias(c) for c in ("mean", "std")], "min",
                    *[rnd(c).alias(c) for c in ("p25", "p50", "p75")], "max")


@query("accuracy",
       f"SELECT count(*) AS n, round(avg(CAST((pred > 0.5) = (label = 1) AS INTEGER)), 6) AS accuracy, "
       f"round(greatest(avg(CAST(label AS DOUBLE)), 1.0 - avg(CAST(label AS DOUBLE))), 6) AS majority_rate "
       f"FROM ({SQL_SCORED})")
def q_accuracy(spark, sf):
    a = Ev.accuracy(scored_labelled(spark, sf))
    return a.select("n", rnd("accuracy").alias("accuracy"), rnd("majority_rate").alias("majority_rate"))


@query("confusion",
       f"SELECT label, CAST(sum(CAST(pred <= 0.5 AS INTEGER)) AS BIGINT) AS pred_0, "
       f"CAST(sum(CAST(pred > 0.5 AS INTEGER)) AS BIGINT) AS pred_1 FROM ({SQL_SCORED}) GROUP BY label")
def q_confusion(spark, sf):
    return Ev.confusion(scored_labelled(spark, sf))


@query("roc_auc",
       f"WITH g AS (SELECT pred AS s, count(*) AS n, CAST(sum(label) AS BIGINT) AS n_pos FROM ({SQL_SCORED}) GROUP BY pred), "
       f"r AS (SELECT s, n, n_pos, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g) "
       f"SELECT round((sum(CAST(n_pos AS DOUBLE) * (CAST(below AS DOUBLE) + (CAST(n AS DOUBLE) + 1.0) / 2.0)) "
       f"- CAST(sum(n_pos) AS DOUBLE) * (CAST(sum(n_pos) AS DOUBLE) + 1.0) / 2.0) "
       f"/ (CAST(sum(n_pos) AS DOUBLE) * CAST(sum(n) - sum(n_pos) AS DOUBLE)), 6) AS auc FROM r")
def q_roc_auc(spark, sf):
    return Ev.roc_auc(scored_labelled(spark, sf)).select(rnd("auc").alias("auc"))


@query("log_loss",
       f"SELECT round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))), 6) AS log_loss, "
       f"round(avg(CAST((pred > 0.5) = (label = 1) AS INTEGER)), 6) AS accuracy FROM "
       f"(SELECT label, pred, least(greatest(pred, 1e-7), 1 - 1e-7) AS p FROM ({SQL_SCORED}))")
def q_log_loss(spark, sf):
    ll = Ev.log_loss(scored_labelled(spark, sf))
    return ll.select(rnd("log_loss").alias("log_loss"), rnd("accuracy").alias("accuracy"))


@query("misclassified",
       f"SELECT doc_id, label, round(pred, 6) AS pred FROM ({SQL_SCORED}) "
       f"WHERE (label < 0.5 AND pred > 0.5) OR (label > 0.5 AND pred < 0.5)")
def q_misclassified(spark, sf):
    return Ev.misclassified(scored_labelled(spark, sf)).select("doc_id", "label", rnd("pred").alias("pred"))


@query("join_predictions",
       f"SELECT d.doc_id, d.text, d.label, round(p.pred, 6) AS pred FROM ({SQL_SENTENCES}) d JOIN "
       f"(SELECT doc_id, pred FROM ({SQL_SCORED})) p ON d.doc_id = p.doc_id")
def q_join_predictions(spark, sf):
    """Predictions joined to their texts and labels by ``doc_id``."""
    docs = sentences_labelled(spark, sf)
    preds = scored_labelled(spark, sf).select("doc_id", rnd("pred").alias("pred"))
    return Ev.with_predictions(docs, preds).select("doc_id", "text", "label", "pred")


@query("word_profile")
def q_word_profile(spark, sf):
    """Words per cleaned labelled document and their different tokens, from stored sketches: the first half of the
    table's parts is profiled and stored, the other half extends it, and the answer is merged from the stored rows."""
    docs = sentences_labelled(spark, sf).withColumn("part", md5_bucket("part", "doc_id", 8))
    counted = docs.select("part", T.word_count("text").alias("n_words"))
    tokens = docs.select("part", F.explode(T.word_tokens("text")).alias("token"))
    numbers, items = shared_path(spark, "number-profile"), shared_path(spark, "item-profile")
    for parts in (F.col("part") < 4, F.col("part") >= 4):
        Sk.extend(Sk.number_profile(counted.where(parts), "n_words", "part"), numbers)
        Sk.extend(Sk.item_profile(tokens.where(parts), "token", "part"), items)
    distinct = Sk.merged_items(Sk.stored(spark, items)).select("n_distinct").scalar()
    return Sk.merged_numbers(Sk.stored(spark, numbers)).withColumn("distinct_tokens", distinct)
