"""Operators against plain-Python versions on small inputs."""

import math
import random
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from reviewspark.functions import tokens as T
from reviewspark.operators import encode as E
from reviewspark.operators import evaluate as Ev
from reviewspark.operators import splits as Sp
from reviewspark.operators import vectors as V
from reviewspark.operators import weights as Wt
from reviewspark.operators.ranking import dense_index, running_total
from reviewspark.operators.tokens import explode_tokens
from reviewspark.operators.vocab import vocab_first_seen, vocab_freq

from conftest import SF001


def test_dense_index_matches_row_number(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.randint(0, 50), rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g int, x double").repartition(7)
    got = dense_index(df, [F.desc("g"), F.asc("x"), F.asc("id")], num_partitions=5)
    want = df.withColumn("idx", F.row_number().over(Window.orderBy(F.desc("g"), F.asc("x"), F.asc("id"))))
    assert got.select("id", "idx").exceptAll(want.select("id", "idx")).count() == 0
    assert got.count() == 3000


def test_running_total(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(500)], "k long, v long").repartition(3)
    got = {r.k: r.cum_before for r in running_total(df, [F.col("k")], "v", num_partitions=4).collect()}
    acc = 0
    for k in range(500):
        assert got[k] == acc
        acc += k % 7


def _docs(spark, n=40):
    d = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(n)
    return d, [(r.doc_id, r.text) for r in d.collect()]


def test_vocab_freq_and_first_seen_plain(spark):
    df, rows = _docs(spark)
    long = explode_tokens(df, T.freq_tokens("text"))
    toks = {r.doc_id: r.t for r in df.select("doc_id", T.freq_tokens("text").alias("t")).collect()}
    order, counts = [], Counter()
    for d in sorted(toks):
        for w in toks[d]:
            if w not in counts:
                order.append(w)
            counts[w] += 1
    first = {w: i for i, w in enumerate(order)}
    want = sorted(order, key=lambda w: (-counts[w], first[w]))
    got = {r.token: r.idx for r in vocab_freq(long).collect()}
    assert got == {w: i + 1 for i, w in enumerate(want)}
    got2 = {r.token: r.idx for r in vocab_first_seen(long).collect()}
    assert got2 == {w: i + 1 for i, w in enumerate(order)}


def test_encode_drop_and_zero(spark):
    df = spark.createDataFrame([(1, "a b c a"), (2, "z z"), (3, "")], "doc_id long, text string")
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "token string, idx long")
    got = {r.doc_id: r.seq for r in E.encode_drop_oov(df, T.whitespace_split("text"), vocab, cap=3).collect()}
    assert got == {1: [1, 2, 1], 2: [], 3: []}
    got = {r.doc_id: r.seq for r in E.encode_oov_zero(df, T.whitespace_split("text"), vocab, keep_below=3).collect()}
    assert got == {1: [1, 2, 0, 1], 2: [0, 0], 3: []}


def test_tfidf_plain_and_unit_norm(spark):
    df, rows = _docs(spark, 30)
    long = explode_tokens(df, T.word_tokens("text"))
    tf = Wt.term_counts(long)
    w = Wt.tfidf(tf, Wt.idf(tf, df)).collect()
    toks = {r.doc_id: r.t for r in df.select("doc_id", T.word_tokens("text").alias("t")).collect()}
    n = len(toks)
    dfreq = Counter(t for ts in toks.values() for t in set(ts))
    want = {}
    for d, ts in toks.items():
        c = Counter(ts)
        raw = {t: k * (math.log((1 + n) / (1 + dfreq[t])) + 1) for t, k in c.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        want.update({(d, t): v / norm for t, v in raw.items()})
    assert len(w) == len(want)
    for r in w:
        assert abs(r.w - want[(r.doc_id, r.token)]) < 1e-12
    norms = Counter()
    for r in w:
        norms[r.doc_id] += r.w * r.w
    assert all(abs(v - 1) < 1e-9 for v in norms.values())


def test_splits_disjoint_exhaustive_stable(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id")
    tr, va = Sp.split_bucket(docs, 0.2, 42)
    a, b = {r[0] for r in tr.collect()}, {r[0] for r in va.collect()}
    assert not (a & b) and len(a | b) == docs.count()
    assert {r[0] for r in Sp.split_bucket(docs, 0.2, 42)[1].collect()} == b
    tail = Sp.with_split_tail(docs, 0.2, 42)
    n = docs.count()
    assert tail.where("split = 'val'").count() == int(0.2 * n)


def test_folds_balanced(spark):
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    f = Sp.with_folds(lab, 3, 42).groupBy("label", "fold").count().collect()
    by = {}
    for r in f:
        by.setdefault(r.label, []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in by.values())


def test_misclassified_half_is_never_wrong(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (2, 0, 0.5), (3, 1, 0.2), (4, 0, 0.9)], "doc_id int, label int, pred double")
    assert sorted(r.doc_id for r in Ev.misclassified(df).collect()) == [3, 4]


def test_auc_matches_pairs(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randint(0, 1), round(rnd.random(), 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id int, label int, pred double")
    got = Ev.roc_auc(df).first()[0]
    pos = [p for _, y, p in rows if y == 1]
    neg = [p for _, y, p in rows if y == 0]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


def test_embedding_matrix_zero_rows(spark):
    vocab = spark.createDataFrame([("a", 1), ("b", 2)], "token string, idx long")
    vecs = spark.createDataFrame([("a", [1.0, 2.0])], "token string, vec array<float>")
    m = {r.idx: r.vec for r in V.embedding_matrix(vocab, vecs, 2).collect()}
    assert m == {0: [0.0, 0.0], 1: [1.0, 2.0], 2: [0.0, 0.0]}


def test_doc_vectors_mean_and_null(spark):
    long = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "z")], "doc_id long, pos int, token string")
    vecs = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0])], "token string, vec array<float>")
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long")
    got = {r.doc_id: r.vec for r in V.doc_vectors(long, vecs, docs=docs).collect()}
    assert got == {1: [2.0, 3.0], 2: None}
