"""The fitted values that the model queries return, against plain computations on the same rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewspark.ml import search as R
from reviewspark.plans import model_queries as M

from conftest import SF001, SF01


@pytest.fixture(scope="module")
def logreg(spark):
    return M.q_logreg_scores(spark, SF01).toPandas()


def test_probabilities_are_of_the_predicted_class(logreg):
    assert ((logreg.prob > 0.5).astype(int) == logreg.pred).all()
    hit = (logreg.pred == logreg.label).mean()
    assert hit > max(logreg.label.mean(), 1 - logreg.label.mean()) + 0.1
    assert logreg[logreg.label == 1].prob.mean() > 0.7 > 0.4 > logreg[logreg.label == 0].prob.mean()


def test_evaluation_of_the_fitted_model(spark, logreg):
    got = {r.metric: r.value for r in M.q_logreg_evaluation(spark, SF01).collect()}
    y, p = logreg.label.to_numpy(), logreg.prob.to_numpy()
    q = np.clip(p, 1e-7, 1 - 1e-7)
    assert got["accuracy"] == pytest.approx(((p > 0.5) == y).mean())
    assert got["log_loss"] == pytest.approx(-(y * np.log(q) + (1 - y) * np.log(1 - q)).mean(), abs=1e-9)
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean())
    assert got["auc"] == pytest.approx(auc) and got["misclassified"] == ((p > 0.5) != y).sum()
    for a in (0, 1):
        for b in (0, 1):
            assert got[f"true_{a}_pred_{b}"] == ((y == a) & ((p > 0.5) == b)).sum()
    wrong = M.q_logreg_wrong_texts(spark, SF01).collect()
    assert {r.doc_id for r in wrong} == set(logreg.doc_id[(p > 0.5) != y]) and all(r.text for r in wrong)


def test_svm_scores_and_terms(spark):
    out = M.q_svm_scores(spark, SF01).toPandas()
    assert ((out.margin > 0).astype(int) == out.pred).all() and (out.pred == out.label).mean() > 0.95
    terms = M.q_svm_top_terms(spark, SF01).toPandas()
    one, zero = terms[terms.side == "label 1"], terms[terms.side == "label 0"]
    assert len(one) == len(zero) == 20 and one.w.min() > 0 > zero.w.max()
    assert {"the", "and", "of"} & set(one.token)


def test_kernel_scores(spark):
    out = M.q_rbf_svm_scores(spark, SF01).toPandas()
    assert ((out.prob > 0.5).astype(int) == out.prediction).all()
    order = np.argsort(out.margin.to_numpy())
    assert (np.diff(out.prob.to_numpy()[order]) >= -1e-12).all()  # Platt scaling keeps the margins' order
    assert (out.prediction == out.label).mean() > max(out.label.mean(), 1 - out.label.mean()) + 0.1


def test_cnn_metrics_are_those_of_its_predictions(spark):
    pred = M.q_cnn_predictions(spark, SF01).toPandas()
    got = {(r.epoch, r.metric): r.value for r in M.q_fit_metrics(spark, SF01).collect()}
    assert set(got) == {(e, m) for e in (1, 2, 3) for m in ("loss", "val_acc", "val_loss")}
    p = np.clip(pred.pred.to_numpy(), 1e-7, 1 - 1e-7)
    y = pred.label.to_numpy()
    assert got[3, "val_acc"] == pytest.approx(((p > 0.5) == y).mean())
    assert got[3, "val_loss"] == pytest.approx(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean(), rel=1e-6)
    assert got[3, "loss"] < got[1, "loss"] and got[3, "val_acc"] > max(y.mean(), 1 - y.mean())


def test_grid_results(spark):
    rows = M.q_grid_results(spark, SF01).orderBy("trial_id").collect()
    assert [(r.ngram_hi, r.use_idf, r.reg_param) for r in rows] == [
        (hi, idf, reg) for hi in (1, 5) for idf in (True, False) for reg in (1e-2, 1e-3)]
    assert all(0.7 < r.mean_accuracy <= 1 and 0 <= r.std_accuracy < 0.2 for r in rows)
    best = max(rows, key=lambda r: (r.mean_accuracy, -r.trial_id))
    assert [r.trial_id for r in rows if r.is_best] == [best.trial_id]


def test_search_results(spark):
    rows = M.q_search_results(spark, SF001).collect()
    best = max(rows, key=lambda r: (r.accuracy, -r.trial_id))
    assert len(rows) == 20 and [r.trial_id for r in rows if r.is_best] == [best.trial_id]
    assert all(0 <= r.accuracy <= 1 and r.accuracy >= 0.5 for r in rows)


def test_guided_linear_search(spark):
    rows = M.q_guided_search(spark, SF001).collect()
    assert len(rows) == 20 and sum(r.is_best for r in rows) == 1
    assert all(1e-4 <= r.reg_param <= 1e-1 and r.max_iter in (20, 30, 50) and r.ngram_hi in (1, 2) for r in rows)


def planted(trials):
    """Best near reg 3e-3 with choice b; a broad slope elsewhere."""
    return [{"accuracy": -abs(math.log10(t["reg"] / 3e-3)) - (0 if t["kind"] == "b" else 0.5) - abs(t["drop"] - 0.2)} for t in trials]


SPACE = {"reg": R.Range(1e-5, 1.0, log=True), "kind": R.Choice(("a", "b", "c", "d")), "drop": R.Range(0.0, 1.0)}


def test_guided_search_beats_blind_draws():
    wins, gain = 0, []
    for seed in range(20):
        guided = max(t["accuracy"] for t in R.guided_search(SPACE, planted, 40, 5, 10, seed))
        blind = max(t["accuracy"] for t in R.guided_search(SPACE, planted, 40, 40, 40, seed))
        wins += guided > blind
        gain.append(guided - blind)
    assert wins >= 14 and np.mean(gain) > 0.05


def test_guided_search_is_reproducible_and_in_bounds():
    one, two = (R.guided_search(SPACE, planted, 17, 5, 5, 3) for _ in range(2))
    assert one == two and [t["trial_id"] for t in one] == list(range(17))
    assert all(1e-5 <= t["reg"] <= 1.0 and 0 <= t["drop"] <= 1 and t["kind"] in "abcd" for t in one)


def test_parzen_densities():
    kind = R.Range(0.0, 10.0)
    p = R.Parzen(kind, [2.0, 2.2, 2.1])
    grid = np.linspace(0, 10, 2001)
    assert p.density(2.1) > 3 * p.density(8.0)
    assert 0.8 < np.mean([p.density(x) for x in grid]) <= 1.0 + 1e-9  # of the unit interval; tails lie outside
    c = R.Parzen(R.Choice(("x", "y")), ["x", "x", "x"])
    assert c.density("x") == pytest.approx(0.8) and c.density("y") == pytest.approx(0.2)
    assert R.Range(1e-4, 1e-1, log=True).from_unit(R.Range(1e-4, 1e-1, log=True).to_unit(3e-3)) == pytest.approx(3e-3)


def test_range_ends_are_inside():
    for low, high in ((1e-4, 1e-1), (1e-3, 1e-2), (3e-5, 0.7)):
        r = R.Range(low, high, log=True)
        assert low <= r.from_unit(0.0) <= r.from_unit(1.0) <= high
    assert R.Range(0.1, 0.7).from_unit(1.0) <= 0.7


def test_guided_cnn_search(spark):
    rng = np.random.default_rng(0)
    emb = rng.normal(size=(30, 6)).astype(np.float32)
    rows = [(i, int(i % 2), [int(v) for v in (rng.integers(1, 15, 10) if i % 2 else rng.integers(15, 30, 10))]) for i in range(160)]
    df = spark.createDataFrame(rows, "doc_id long, label int, x array<int>")
    out = R.guided_cnn_search(df.where("doc_id < 120"), df.where("doc_id >= 120"), emb, 10, n_trials=3, batch=2).collect()
    assert len(out) == 3 and sum(r.is_best for r in out) == 1
    assert max(out, key=lambda r: (r.accuracy, -r.trial_id)).is_best and all(r.width in (3, 4, 5, 6, 7) for r in out)


def test_similar_words_have_their_cosines(spark):
    near, top, vectors = M.nearest_words(spark, SF01)
    got = M.q_word2vec_similar(spark, SF01)
    assert got.columns == ["word", "neighbour", "cosine"] and got.count() == 10
    v = {r.word: np.array(r.vec) for r in vectors.collect()}
    cos = lambda a, b: float(v[a] @ v[b] / np.linalg.norm(v[a]) / np.linalg.norm(v[b]))
    rows = near.collect()
    for r in rows:
        assert r.similarity == pytest.approx(cos(top, r.word), abs=1e-4)
    assert sorted(v, key=lambda w: -cos(top, w) if w != top else 9)[:10] != [] and rows[0].similarity == max(r.similarity for r in rows)


def test_thinned_arrays_need_one_shuffle(spark):
    """Only the word count shuffles: the thinned rows themselves are a scan, a filter and a projection."""
    from reviewspark.operators.vectors import subsample_arrays
    docs = spark.createDataFrame([(i, ["the"] * 30 + [f"w{i}", "of"] * 3) for i in range(200)], "doc_id long, words array<string>")
    out = subsample_arrays(docs, "words", ("doc_id",), 1e-2, 8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Generate" not in plan
    rows = out.collect()
    kept = [w.token for r in rows for w in r.words]
    total = {"the": 6000, "of": 600}
    for word, n in total.items():
        f = n / 7200
        p = (math.sqrt(f / 1e-2) + 1) * 1e-2 / f
        assert abs(kept.count(word) / n - p) < 4 * math.sqrt(p * (1 - p) / n) + 0.01
    assert all(kept.count(f"w{i}") == 3 for i in range(200))
    assert all(0 <= w.pos < 36 for r in rows for w in r.words)
