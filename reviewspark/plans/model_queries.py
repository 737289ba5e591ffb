"""Model queries.

All use the learnable target ``label = (lang = 'en')`` over every document and the md5 bucket split (20 %
validation).  Features are term counts on the counted vocabulary of the training rows.

Each model has two queries.  One has a SQL twin: it reports what the data determine (rows, labels, parameters, shares)
and whether the fit beats the majority class, which a model that learned nothing does not.  The other returns the
fitted values (margins, probabilities, weights, vectors, metrics, accuracies); ``tests/test_model_results.py`` holds
those against plain computations.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..catalog import query
from ..functions import tokens as T
from ..functions.fixed import MAX_SEQUENCE_LENGTH
from ..ml import span as Sp
from ..ml.kernel import fit_rbf_svm
from ..ml.search import best_trial, grid_search, guided_cnn_search, guided_linear_search, random_search
from ..ml.word2vec import fit_word2vec
from ..operators import evaluate as Ev
from ..operators.splits import with_split_bucket
from ..operators.tokens import explode_tokens
from ..operators.vectors import doc_vectors
from ..oracle import sqltext as S
from ..sources import tables
from ..sources.vectors import bound_vectors
from ..session import ensure_checkpoint_dir, materialize, shared_path
from .common import rnd

_SQL_TARGET = ("SELECT doc_id, CAST(lang = 'en' AS INTEGER) AS label FROM documents")
_SQL_VAL = f"SELECT * FROM ({_SQL_TARGET}) WHERE {S.md5_int(42, 'doc_id')} % 100 < 20"
_SQL_MAJORITY = ("count(*) AS n, round(greatest(avg(label), 1 - avg(label)), 6) AS majority_rate")


CNN_BATCH, CNN_EPOCHS = 32, 3


def _target(spark, sf):
    docs = tables.language_target(spark, sf)
    return with_split_bucket(docs, 0.2, 42)


def linear_fit(spark, sf, loss: str = "hinge", turns: int = 20) -> Sp.Fitted:
    """The linear SVM or logistic regression on smooth tf-idf of the training rows."""
    return Sp.fit_all(Sp.text_features(_target(spark, sf), [Sp.Variant()]), [Sp.Fit(0, 1e-3, loss, turns)])


def linear_scores(fitted: Sp.Fitted):
    """``(doc_id, label, margin, prob, pred)`` of the validation rows."""
    out = fitted.scores().where("NOT train0")
    prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin0")))
    return out.select("doc_id", "label", F.col("margin0").alias("margin"), prob.alias("prob"),
                      (F.col("margin0") > 0).cast("int").alias("pred"))


def with_verdict(scored):
    """``(doc_id, label, beats_majority)``: every scored row, and whether the predictions ``pred`` (class or probability)
    are right more often than the majority class is."""
    scored = materialize(scored.select("doc_id", "label", "pred"), "scored")
    beats = Ev.accuracy(scored).select(F.col("accuracy") > F.col("majority_rate")).scalar()
    return scored.select("doc_id", "label", beats.alias("beats_majority"))


@query("svm_predict", f"SELECT doc_id, label, true AS beats_majority FROM ({_SQL_VAL})")
def q_svm_predict(spark, sf):
    """Linear SVM on smooth tf-idf: every validation row, and whether the predictions beat the majority class."""
    return with_verdict(linear_scores(linear_fit(spark, sf)))


@query("svm_scores")
def q_svm_scores(spark, sf):
    """The validation rows with margin and predicted class of the linear SVM."""
    return linear_scores(linear_fit(spark, sf)).select("doc_id", "label", "margin", "pred")


@query("svm_top_terms")
def q_svm_top_terms(spark, sf):
    """The 20 terms with the largest and the 20 with the smallest weight of the linear SVM."""
    w = materialize(linear_fit(spark, sf).weights(), "svm-weights")
    top = w.orderBy(F.desc("w"), "token").limit(20).select("token", "w", F.lit("label 1").alias("side"))
    return top.unionByName(w.orderBy(F.asc("w"), "token").limit(20).select("token", "w", F.lit("label 0").alias("side")))


@query("logreg_predict", f"SELECT doc_id, label, true AS beats_majority FROM ({_SQL_VAL})")
def q_logreg_predict(spark, sf):
    return with_verdict(linear_scores(linear_fit(spark, sf, "log")))


@query("logreg_scores")
def q_logreg_scores(spark, sf):
    """The validation rows with the probability and predicted class of the logistic regression."""
    return linear_scores(linear_fit(spark, sf, "log")).select("doc_id", "label", "prob", "pred")


@query("logreg_evaluation")
def q_logreg_evaluation(spark, sf):
    """The evaluation operators on a fitted model: accuracy, majority rate, log loss, AUC, confusion and the number of
    misclassified rows of the logistic regression's validation probabilities, as ``(metric, value)``."""
    scored = materialize(linear_scores(linear_fit(spark, sf, "log")).select("doc_id", "label", F.col("prob").alias("pred")), "scored")
    conf = Ev.confusion(scored)
    cells = conf.select(F.explode(F.array(*[F.struct(F.concat(F.lit("true_"), "label", F.lit(f"_pred_{c}")).alias("metric"),
                                                     F.col(f"pred_{c}").cast("double").alias("value")) for c in (0, 1)])).alias("r")).select("r.*")
    parts = [Ev.accuracy(scored).select("accuracy", "majority_rate"), Ev.log_loss(scored).select("log_loss"), Ev.roc_auc(scored),
             Ev.misclassified(scored).agg(F.count(F.lit(1)).cast("double").alias("misclassified"))]
    for p in parts:
        for c in p.columns:
            cells = cells.unionByName(p.select(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")))
    return cells


@query("logreg_wrong_texts")
def q_logreg_wrong_texts(spark, sf):
    """Misclassified validation documents of the logistic regression, joined to their texts by key."""
    scored = linear_scores(linear_fit(spark, sf, "log")).select("doc_id", "label", F.col("prob").alias("pred"))
    docs = tables.documents(spark, sf).select("doc_id", "text")
    return Ev.with_predictions(docs, Ev.misclassified(scored)).select("doc_id", "label", "pred", "text")


@query("svm_accuracy", f"SELECT {_SQL_MAJORITY}, true AS beats_majority FROM ({_SQL_VAL})")
def q_svm_accuracy(spark, sf):
    """Validation accuracy of the linear SVM against the majority-class rate."""
    acc = Ev.accuracy(linear_scores(linear_fit(spark, sf)))
    return acc.select("n", rnd("majority_rate").alias("majority_rate"),
                      (F.col("accuracy") > F.col("majority_rate")).alias("beats_majority"))


def rbf_predictions(spark, sf):
    """Approximate RBF-kernel SVM on mean word vectors, Platt probabilities, for every validation row.

    A document without any known word has no mean vector; it stands as the zero vector.
    """
    docs = _target(spark, sf)
    long = explode_tokens(docs, T.review_words("text"))
    vecs = doc_vectors(long, bound_vectors(spark, sf), docs=docs)
    zero = F.array_repeat(F.lit(0.0), 64)
    data = materialize(docs.select("doc_id", "label", "split").join(vecs, "doc_id", "left")
                       .withColumn("vec", F.coalesce("vec", zero)), "doc-vectors")
    predict = fit_rbf_svm(data.where("split = 'train'"), dim=64, vec="vec", gamma=1.0)
    return predict(data.where("split = 'val'"))


@query("rbf_svm_predict", f"SELECT doc_id, label, true AS beats_majority FROM ({_SQL_VAL})")
def q_rbf_svm_predict(spark, sf):
    return with_verdict(rbf_predictions(spark, sf).withColumn("pred", F.col("prob")))


@query("rbf_svm_scores")
def q_rbf_svm_scores(spark, sf):
    """The validation rows with margin, Platt probability and class of the kernel SVM."""
    return rbf_predictions(spark, sf).select("doc_id", "label", "margin", "prob", "prediction")


_SQL_SENT_WORDS = ("SELECT doc_id, generate_subscripts(sw, 1) - 1 AS sent_no, unnest(sw) AS w FROM (SELECT doc_id, "
                   "list_transform(" + S.sentence_split(S.ascii_only("text")) + ", lambda s: " + S.review_words("s")
                   + ") AS sw FROM documents)")
_SQL_W2V_WORDS = (
    f"WITH t AS (SELECT doc_id, sent_no, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos FROM ({_SQL_SENT_WORDS})), "
    "c AS (SELECT token, count(*) AS c FROM t GROUP BY token), tot AS (SELECT count(*) AS n FROM t), "
    "k AS (SELECT t.token FROM t JOIN c ON t.token = c.token CROSS JOIN tot WHERE (CAST(('0x' || substr(md5('8:' || "
    "CAST(t.doc_id AS VARCHAR) || ':' || CAST(t.sent_no AS VARCHAR) || ':' || CAST(t.pos AS VARCHAR)), 1, 8))::BIGINT AS DOUBLE) "
    "/ CAST(4294967296 AS DOUBLE)) < least(1.0, (sqrt((CAST(c.c AS DOUBLE) / CAST(tot.n AS DOUBLE)) / 0.001) + 1.0) * 0.001 "
    "/ (CAST(c.c AS DOUBLE) / CAST(tot.n AS DOUBLE))))")


@query("word2vec_fit", _SQL_W2V_WORDS + " SELECT token AS word, 200 AS dim, true AS finite FROM k GROUP BY token HAVING count(*) >= 40")
def q_word2vec_fit(spark, sf):
    """Skip-gram vectors on the sentence corpus of all documents after frequent-word subsampling."""
    vectors = fit_word2vec(tables.documents(spark, sf))
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    return vectors.select("word", F.size("vec").alias("dim"), ((norm > 0) & (norm < float("inf"))).alias("finite"))


@query("grid_search",
       "SELECT row_number() OVER (ORDER BY h.i, u.i, r.i) - 1 AS trial_id, h.v AS ngram_hi, u.v AS use_idf, r.v AS reg_param, "
       "true AS beats_majority FROM (VALUES (0, 1), (1, 5)) h(i, v), (VALUES (0, true), (1, false)) u(i, v), "
       "(VALUES (0, CAST(0.01 AS DOUBLE)), (1, CAST(0.001 AS DOUBLE))) r(i, v)")
def q_grid_search(spark, sf):
    """8 combinations (n-gram range x idf x regularisation), 3 stratified folds: the grid, and whether each point's
    mean accuracy beats the majority rate."""
    docs = tables.language_target(spark, sf)
    p = docs.agg(F.avg(F.col("label").cast("double")).alias("p")).first()["p"]
    res = grid_search(docs)
    return res.select(F.col("trial_id").cast("bigint").alias("trial_id"), "ngram_hi", "use_idf", "reg_param",
                      (F.col("mean_accuracy") > max(p, 1 - p)).alias("beats_majority"))


@query("grid_results")
def q_grid_results(spark, sf):
    """The grid's points with mean and standard deviation of their fold accuracies, and whether a point is the best."""
    res = grid_search(tables.language_target(spark, sf))
    best = best_trial(res, "mean_accuracy").select(F.col("trial_id").alias("best"))
    return res.join(F.broadcast(best), F.col("trial_id") == F.col("best"), "left").withColumn("is_best", F.col("best").isNotNull()).drop("best")


_U = lambda p: ("(CAST(('0x' || substr(md5('42:' || CAST(t AS VARCHAR) || ':" + p + "'), 1, 8))::BIGINT AS DOUBLE) / "  # noqa: E731
                "CAST(4294967296 AS DOUBLE))")


@query("search_run",
       f"SELECT t AS trial_id, round(pow(CAST(10 AS DOUBLE), CAST(-4 AS DOUBLE) + CAST(3 AS DOUBLE) * {_U('reg')}), 9) AS reg_param, "
       f"[20, 30, 50][CAST(floor({_U('iter')} * 3) AS INTEGER) + 1] AS max_iter, "
       f"[1, 2][CAST(floor({_U('ngram')} * 2) AS INTEGER) + 1] AS ngram_hi, {_U('idf')} < 0.5 AS use_idf, "
       f"(SELECT round(greatest(avg(label), 1 - avg(label)), 6) FROM ({_SQL_VAL})) AS majority_rate, true AS beats_majority FROM range(20) r(t)")
def q_search_run(spark, sf):
    """Seeded random search over 20 trials: the trial table and the majority rate its accuracies are measured by."""
    res = random_search(tables.language_target(spark, sf))
    return res.select("trial_id", F.round("reg_param", 9).alias("reg_param"), "max_iter", "ngram_hi", "use_idf",
                      rnd("majority_rate").alias("majority_rate"), (F.col("accuracy") > F.col("majority_rate")).alias("beats_majority"))


@query("search_results")
def q_search_results(spark, sf):
    """The random search's trials with their accuracies; ``is_best`` marks the best one."""
    return random_search(tables.language_target(spark, sf))


@query("guided_search")
def q_guided_search(spark, sf):
    """20 Parzen-guided trials of the linear classifier in batches of five, with accuracies and ``is_best``."""
    return guided_linear_search(tables.language_target(spark, sf))


@query("guided_cnn_search")
def q_guided_cnn_search(spark, sf):
    """Parzen-guided trials of the text CNN over its width, L2, dropout, units, filters, batch size and step size."""
    from .cnn_inputs import cnn_inputs
    rows, emb = cnn_inputs(spark, sf, max_len=MAX_SEQUENCE_LENGTH)
    return guided_cnn_search(rows.where("split = 'train'"), rows.where("split = 'val'"), emb, MAX_SEQUENCE_LENGTH)


def _cnn(spark, sf, epochs):
    from ..ml import cnn
    from .cnn_inputs import cnn_inputs
    rows, emb = cnn_inputs(spark, sf, max_len=MAX_SEQUENCE_LENGTH)
    spec = cnn.CnnSpec(max_len=MAX_SEQUENCE_LENGTH, dim=64, lr=3e-3)
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    # one folder for a run of the same data and settings: a rerun goes on from its last finished epoch
    run = hashlib.md5(repr((sf, rows.count(), sorted(vars(spec).items()), CNN_BATCH, len(emb))).encode()).hexdigest()
    state = f"{ensure_checkpoint_dir(spark).rstrip('/')}/states/cnn-{run}"
    theta, history = cnn.fit(train, spec, emb, epochs=epochs, batch_size=CNN_BATCH, val=val, state_path=state)
    return cnn, spec, theta, emb, val, history


@query("cnn_score", f"SELECT doc_id, label, true AS beats_majority FROM ({_SQL_VAL})")
def q_cnn_score(spark, sf):
    """Every validation row, and whether the text CNN's probabilities beat the majority class after three epochs."""
    cnn, spec, theta, emb, val, _ = _cnn(spark, sf, epochs=CNN_EPOCHS)
    return with_verdict(cnn.score(val, spec, theta, emb))


@query("cnn_predictions")
def q_cnn_predictions(spark, sf):
    """The validation rows with the text CNN's probability of class 1."""
    cnn, spec, theta, emb, val, _ = _cnn(spark, sf, epochs=CNN_EPOCHS)
    return cnn.score(val, spec, theta, emb).select("doc_id", "label", "pred")


def _history(spark, sf):
    """Per-epoch metrics of a text-CNN fit, appended to a Parquet history table and read back."""
    from ..sinks.writers import append_history
    _, _, _, _, _, history = _cnn(spark, sf, epochs=CNN_EPOCHS)
    path = shared_path(spark, "history")
    append_history(spark.createDataFrame(history, "run_id string, epoch int, metric string, value double"), path)
    return spark.read.parquet(path)


@query("fit_history",
       f"SELECT 'cnn' AS run_id, CAST(e AS INTEGER) AS epoch, m AS metric, true AS learned FROM range(1, {CNN_EPOCHS + 1}) r(e), "
       "(VALUES ('loss'), ('val_acc'), ('val_loss')) v(m)")
def q_fit_history(spark, sf):
    """The epochs and metrics of a text-CNN fit, and whether the training loss fell from the first to the last epoch
    and the last validation accuracy beats the majority class."""
    back = _history(spark, sf)
    val = _target(spark, sf).where("split = 'val'").agg(F.avg(F.col("label").cast("double")).alias("p"))
    majority = val.select(F.greatest("p", 1 - F.col("p"))).scalar()
    ends = back.where("metric = 'loss'").agg(F.min_by("value", "epoch").alias("first"), F.max_by("value", "epoch").alias("last"))
    acc = back.where("metric = 'val_acc'").agg(F.max_by("value", "epoch").alias("acc"))
    learned = ends.select(F.col("last") < F.col("first")).scalar() & (acc.select("acc").scalar() > majority)
    return back.select("run_id", "epoch", "metric", learned.alias("learned"))


@query("fit_metrics")
def q_fit_metrics(spark, sf):
    """Per-epoch loss, validation accuracy and validation loss of a text-CNN fit."""
    return _history(spark, sf).select("run_id", "epoch", "metric", "value")


def nearest_words(spark, sf, n: int = 10):
    """``(word, similarity)`` of the ``n`` words nearest to the most frequent one, that word, and all vectors."""
    vectors, model, _ = fit_word2vec(tables.documents(spark, sf), return_model=True)
    top = model.words.orderBy(F.desc("n"), F.asc("word")).first()["word"]          # one word
    return model.findSynonyms(top, n).orderBy(F.desc("similarity"), "word"), top, vectors


@query("word2vec_neighbours",
       _SQL_W2V_WORDS + ", f AS (SELECT token, count(*) AS n FROM k GROUP BY token), "
       "q AS (SELECT token FROM f ORDER BY n DESC, token LIMIT 1) "
       "SELECT q.token AS word, r AS rank, true AS in_vocabulary FROM q, range(1, 11) x(r)")
def q_word2vec_neighbours(spark, sf):
    """Ten nearest words (cosine) of the most frequent word of the subsampled corpus, in the trained space."""
    near, top, vectors = nearest_words(spark, sf)
    known = vectors.select("word", F.lit(True).alias("known"))
    joined = near.join(known, "word", "left")
    w = Window.orderBy(F.desc("similarity"), "word")                 # ten rows
    return joined.select(F.lit(top).alias("word"), F.row_number().over(w).cast("bigint").alias("rank"),
                         (F.coalesce("known", F.lit(False)) & (F.col("word") != top)).alias("in_vocabulary"))


@query("word2vec_similar")
def q_word2vec_similar(spark, sf):
    """The same ten words with their cosines."""
    near, top, _ = nearest_words(spark, sf)
    return near.select(F.lit(top).alias("word"), F.col("word").alias("neighbour"), F.col("similarity").alias("cosine"))
