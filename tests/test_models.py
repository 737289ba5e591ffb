"""Model invariants: beat the majority rate on the learnable target; CNN
gradient against finite differences; data-parallel gradient independent of
the partitioning; scoring equals a plain numpy forward."""

import numpy as np
from pyspark.sql import functions as F

from reviewspark.ml import cnn
from reviewspark.ml import linear as L
from reviewspark.operators.evaluate import accuracy
from reviewspark.operators.splits import with_split_bucket
from reviewspark.sources import tables

from conftest import SF01


def test_svm_beats_majority(spark):
    data = L.with_token_columns(with_split_bucket(tables.language_target(spark, SF01), 0.2, 42))
    model = L.svm_pipeline(1e-3, 20).fit(data.where("split = 'train'"))
    pred = model.transform(data.where("split = 'val'"))
    acc = accuracy(pred.select("label", F.col("prediction").alias("pred"))).first()
    assert acc.accuracy > acc.majority_rate + 0.1


def test_smooth_idf_matches_relational(spark):
    from reviewspark.operators import weights as Wt
    from reviewspark.operators.tokens import explode_tokens
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(40)
    docs = L.with_token_columns(docs).cache()
    stages = L.text_features("tokens")
    from pyspark.ml import Pipeline
    model = Pipeline(stages=stages).fit(docs)
    vocab = model.stages[0].vocabulary
    feats = {r.doc_id: r.features for r in model.transform(docs).select("doc_id", "features").collect()}
    long = explode_tokens(docs, F.col("tokens"))
    tf = Wt.term_counts(long)
    rel = Wt.tfidf(tf, Wt.idf(tf, docs)).collect()
    index = {t: i for i, t in enumerate(vocab)}
    for r in rel:
        assert abs(feats[r.doc_id][index[r.token]] - r.w) < 1e-9


def _tiny():
    spec = cnn.CnnSpec(max_len=12, dim=4, widths=(2, 3), filters=3, hidden=5, dropout=0.0, seed=3)
    rng = np.random.default_rng(0)
    emb = rng.normal(size=(20, 4)).astype(np.float32)
    emb[0] = 0
    x = rng.integers(0, 20, size=(6, 12))
    y = rng.integers(0, 2, size=6).astype(float)
    return spec, emb, x, y


def test_cnn_gradient_finite_difference():
    spec, emb, x, y = _tiny()
    theta = spec.init()

    def loss(th):
        p, _ = cnn.forward(spec, spec.unpack(th), emb.astype(np.float64), x)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum())

    p, state = cnn.forward(spec, spec.unpack(theta), emb.astype(np.float64), x)
    g = spec.pack(cnn.backward(spec, spec.unpack(theta), p, y, state))
    rng = np.random.default_rng(1)
    for i in rng.choice(theta.size, 25, replace=False):
        e = np.zeros_like(theta)
        e[i] = 1e-6
        num = (loss(theta + e) - loss(theta - e)) / 2e-6
        assert abs(num - g[i]) < 1e-4 * max(1.0, abs(num))


def test_cnn_fit_is_independent_of_partitions(spark):
    spec, emb, x, y = _tiny()
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 2)), [int(v) for v in rng.integers(0, 20, 12)]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, label int, x array<int>")
    fits = [cnn.fit(df.repartition(n), spec, emb, epochs=2, batch_size=8, local_steps=2, workers=4) for n in (1, 5)]
    assert np.allclose(fits[0][0], fits[1][0]) and np.allclose([h[3] for h in fits[0][1]], [h[3] for h in fits[1][1]])


def test_a_round_averages_its_cells_by_rows(spark):
    """Two cells trained apart in numpy, averaged by rows, are what one round gives."""
    spec, emb, x, y = _tiny()
    rng = np.random.default_rng(6)
    rows = [(i, int(rng.integers(0, 2)), [int(v) for v in rng.integers(0, 20, 12)]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, label int, x array<int>")
    table, rounds = cnn.dealt_rows(df, spec, 10, 2, 4)
    assert rounds == 1
    theta = spec.init()
    state = np.concatenate([theta, np.zeros_like(theta), np.zeros_like(theta)])
    got, loss, n = cnn.run_round(table, spec, emb, state, 0, 1, 10, False, 4)
    want, total = np.zeros_like(state), 0
    cells = {}
    for r in table.collect():
        cells.setdefault(r.cell, []).append(r)
    for held in cells.values():
        held.sort(key=lambda r: r.doc_id)
        new, part = cnn.adam_steps(spec, emb, np.array([r.doc_id for r in held]), np.array([r.x for r in held]),
                                   np.array([float(r.label) for r in held]), state, 0, 1, 10, False)
        want, total = want + len(held) * new, total + part
    assert n == 40 and len(cells) == 2 and np.allclose(got, want / 40) and abs(loss - total) < 1e-9


def test_gradient_rows_are_summed_in_several_tasks(spark):
    from pyspark.sql import functions as F
    rows = spark.range(0, 400, 1, 40).selectExpr("1L as n", "cast(id as double) as loss", "unhex('000000000000F03F') as grad")
    out = cnn.tree_sum(rows, 1, 8)
    parts = out.withColumn("p", F.spark_partition_id()).collect()
    assert len({r.p for r in parts}) > 4 and sum(r.n for r in parts) == 400
    assert sum(np.frombuffer(r.grad, float)[0] for r in parts) == 400.0


def test_dropout_draws_do_not_depend_on_partitions():
    ids = np.arange(1000)
    a = cnn.uniform(8, 3, ids, 64)
    assert (a[::-1] == cnn.uniform(8, 3, ids[::-1], 64)).all() and 0.49 < a.mean() < 0.51
    assert abs(np.corrcoef(a[:, 0], a[:, 1])[0, 1]) < 0.1 and (a != cnn.uniform(8, 4, ids, 64)).mean() > 0.99


def test_cnn_score_equals_numpy_forward(spark):
    spec, emb, x, y = _tiny()
    rows = [(i, int(y[i]), [int(v) for v in x[i]]) for i in range(len(y))]
    df = spark.createDataFrame(rows, "doc_id long, label int, x array<int>").repartition(3)
    theta = spec.init()
    got = {r.doc_id: r.pred for r in cnn.score(df, spec, theta, emb).collect()}
    want, _ = cnn.forward(spec, spec.unpack(theta), emb, x)
    assert np.allclose([got[i] for i in range(len(y))], want, atol=1e-6)


def test_cnn_fit_resumes_from_state(spark, tmp_path):
    spec, emb, x, y = _tiny()
    rows = [(i, int(y[i]), [int(v) for v in x[i]]) for i in range(len(y))]
    df = spark.createDataFrame(rows, "doc_id long, label int, x array<int>")
    full, hist_full = cnn.fit(df, spec, emb, epochs=2, batch_size=100, dropout=False)
    path = str(tmp_path / "state")
    cnn.fit(df, spec, emb, epochs=1, batch_size=100, dropout=False, state_path=path)
    resumed, hist = cnn.fit(df, spec, emb, epochs=2, batch_size=100, dropout=False, state_path=path)
    assert np.allclose(full, resumed)
    assert [h[:3] for h in hist] == [h[:3] for h in hist_full]
    one, hist = cnn.fit(df, spec, emb, epochs=1, batch_size=100, dropout=False, state_path=path)  # an earlier epoch's state
    assert len(hist) == 1 and not np.allclose(one, full)


def test_pipeline_with_smooth_idf_saves_and_loads(spark, tmp_path):
    from pyspark.ml import PipelineModel
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    data = L.with_token_columns(docs.withColumn("label", (F.col("lang") == "en").cast("int")))
    model = L.svm_pipeline(1e-3, 5).fit(data)
    path = str(tmp_path / "svm")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = [r.prediction for r in model.transform(data).orderBy("doc_id").collect()]
    b = [r.prediction for r in back.transform(data).orderBy("doc_id").collect()]
    assert a == b


def test_cnn_work_grows_with_words_not_with_padding():
    """Products are made once per distinct word, padding is not convolved, and every value is that of the plain sum."""
    rng = np.random.default_rng(4)
    spec = cnn.CnnSpec(max_len=400, dim=5, widths=(2, 4), filters=3, hidden=4, seed=2)
    emb = rng.normal(size=(30, 5))
    x = np.zeros((7, 400), dtype=int)
    for i, n in enumerate((0, 1, 2, 3, 40, 399, 400)):
        x[i, 400 - n:] = rng.integers(0, 30, n)
    theta = spec.init() + 0.01
    p = spec.unpack(theta)
    got, (h0, _, _, cache) = cnn.forward(spec, p, emb, x)
    want = []
    for w in spec.widths:
        win = np.lib.stride_tricks.sliding_window_view(emb[x], w, axis=1)  # (B, T, d, w)
        want.append(np.maximum(np.einsum("btdk,fkd->btf", win, p[f"conv{w}_w"]).max(axis=1) + p[f"conv{w}_b"], 0))
    assert np.allclose(h0, np.concatenate(want, axis=1), rtol=1e-12, atol=1e-12)
    words, places = cache[0][0], cache[0][1]
    assert len(words) <= 30 and len(places) <= (0 + 1 + 2 + 3 + 40 + 399 + 400) + 7 * 4 + 30


def test_cnn_forward_holds_the_sums_of_one_row(monkeypatch):
    """The sums over a batch's windows are never held for all rows, and equal those of each row alone."""
    import tracemalloc
    spec = cnn.CnnSpec(max_len=400, dim=8, widths=(3, 4, 5), filters=32, hidden=6, seed=1)
    rng = np.random.default_rng(2)
    emb = rng.normal(size=(50, 8)).astype(np.float32)
    x = rng.integers(1, 50, (256, 400))
    p = spec.unpack(spec.init())
    want = np.concatenate([cnn.forward(spec, p, emb, x[i:i + 1])[0] for i in range(len(x))])
    tracemalloc.start()
    got, _ = cnn.forward(spec, p, emb, x)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got, want, rtol=1e-12) and most < 256 * 400 * 32 * 8 / 2
