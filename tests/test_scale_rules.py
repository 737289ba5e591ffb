"""No constant depends on a table's size; hot tokens stay exact; boundaries come from histograms."""

import random

from pyspark.sql import functions as F

from reviewspark.operators import splits, vectors, weights
from reviewspark.operators.joins import measured
from reviewspark.plans import vocab_queries
from reviewspark.session import materialize, release_intermediates
from reviewspark.sources import text as Tx
from reviewspark.sources.vectors import bound_vectors, read_vector_text
from reviewspark.sinks.writers import write_vectors_text

SF = "/root/testdata"


def test_every_embedding_row_is_bound(spark):
    for sf, rows in (("sf0.01", 500), ("sf0.1", 2000)):
        words = spark.read.parquet(f"{SF}/{sf}/documents.parquet").select(
            F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0)).alias("token")).distinct().count()
        bound = bound_vectors(spark, f"{SF}/{sf}")
        assert spark.read.parquet(f"{SF}/{sf}/embeddings.parquet").count() == rows
        assert bound.select("vec").distinct().count() > 0.99 * rows
        assert 0.69 < bound.count() / words < 0.74  # five sevenths of the words have a vector


def test_word_cap_is_the_fixed_value():
    assert vocab_queries.NUM_WORDS == 10_000


def hot_tokens(spark):
    rng = random.Random(3)
    rows = [(d, p, "the" if rng.random() < 0.34 else f"w{rng.randrange(200)}") for d in range(60) for p in range(80)]
    return rows, spark.createDataFrame(rows, "doc_id long, pos int, token string")


def test_doc_vectors_with_a_hot_token(spark):
    rows, df = hot_tokens(spark)
    vec = {f"w{i}": [float(i), 1.0] for i in range(150)} | {"the": [500.0, -1.0]}
    table = spark.createDataFrame(list(vec.items()), "token string, vec array<float>")
    docs = spark.range(62).withColumnRenamed("id", "doc_id")
    got = {r.doc_id: r.vec for r in vectors.doc_vectors(df, table, docs=docs).collect()}
    assert got[60] is None and got[61] is None and len(got) == 62
    for d in range(60):
        known = [vec[t] for x, _, t in rows if x == d and t in vec]
        want = [sum(v[k] for v in known) / len(known) for k in range(2)]
        assert all(abs(a - b) < 1e-6 for a, b in zip(got[d], want))


def test_validation_counts_and_weights_with_a_hot_token(spark):
    rows, df = hot_tokens(spark)
    vocab = {f"w{i}" for i in range(100)} | {"the"}
    got = weights.term_counts_in_vocab(df, spark.createDataFrame([(v,) for v in vocab], "token string"))
    want = {}
    for d, _, t in rows:
        if t in vocab:
            want[d, t] = want.get((d, t), 0) + 1
    assert {(r.doc_id, r.token): r.tf for r in got.collect()} == want


def test_splits_and_samples_by_histogram(spark):
    rng = random.Random(1)
    ids = rng.sample(range(10**12), 500) + [10**15]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    order = [r.doc_id for r in df.orderBy(*splits.shuffle_order(42)).collect()]
    for n in (1, 7, 499, 600):
        assert [r.doc_id for r in splits.downsample(df, n).collect()] == order[:n]
    val = {r.doc_id for r in splits.with_split_exact(df, 0.2).where("split = 'val'").collect()}
    assert val == set(order[:round(0.2 * 501)])
    tail = {r.doc_id for r in splits.with_split_tail(df, 0.2).where("split = 'val'").collect()}
    assert tail == set(order[501 - int(0.2 * 501):])
    ordered = {r.doc_id for r in splits.with_split_tail_ordered(df, 0.2).where("split = 'train'").collect()}
    assert ordered == set(sorted(ids)[:int(501 * 0.8)])
    for frac in (0.0, 1.0):
        assert splits.with_split_exact(df, frac).where("split = 'val'").count() == round(frac * 501)


def test_header_is_the_first_line_and_no_other_is_dropped(spark, tmp_path):
    rows = [(str(i), [float(i)]) for i in range(50)]  # one-dimensional: every line looks like a header
    v = spark.createDataFrame(rows, "token string, vec array<float>").repartition(4)
    write_vectors_text(v, str(tmp_path / "v"), header=True)
    files = [p for p in (tmp_path / "v").iterdir() if p.name.startswith("part-") and p.stat().st_size]
    assert files and all(p.read_text().splitlines()[0] == "50 1" for p in files)
    back = read_vector_text(spark, str(tmp_path / "v"), header=True)
    assert {(r.token, r.vec[0]) for r in back.collect()} == {(t, x[0]) for t, x in rows}


def test_label_code(spark):
    got = spark.createDataFrame([("pos",), ("neg",), ("other",), (None,)], "c string").select(Tx.label_code("c").alias("v")).collect()
    assert [r.v for r in got] == [1, 0, None, None]


def test_intermediates_are_given_back(spark):
    release_intermediates(spark)
    path = materialize(spark.range(5), "given-back").inputFiles()[0]
    assert release_intermediates(spark) == 1
    import os
    assert not os.path.exists(path.replace("file://", ""))


def test_measured_counts_text_in_full(spark):
    df = spark.createDataFrame([("x" * 1000, 1), (None, 2)], "token string, idx long")
    assert measured(df) == (2, 1000 + 2 * 32)


def test_doc_vectors_carry_no_vector_a_token_of_a_document(spark):
    """A block is sent each vector once: no aggregate of vectors over the counted rows; tokens that come twice count twice."""
    _, df = hot_tokens(spark)
    table = spark.createDataFrame([("the", [2.0, 4.0]), ("w1", [1.0, 1.0]), ("w1", [3.0, 1.0])], "token string, vec array<float>")
    out = vectors.doc_vectors(df, table)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "aggregate_metrics" not in plan
    small = spark.createDataFrame([(None, 0, "w1"), (None, 1, "the"), (5, 0, "w1"), (6, 0, "x")], "doc_id long, pos int, token string")
    assert {r.doc_id: r.vec for r in vectors.doc_vectors(small, table).collect()} == {None: [2.0, 2.0], 5: [2.0, 1.0]}


def test_doc_vectors_in_waves_are_the_same(spark, monkeypatch):
    """Many blocks are done in waves, every document in one of them; each wave's shuffles end with it."""
    from reviewspark import session
    rows = [(None if i % 50 == 7 else i % 40, i, f"w{i * i % 23}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, pos int, token string")
    table = spark.createDataFrame([(f"w{i}", [float(i), 1.0]) for i in range(0, 23, 2)] + [("w4", [0.5, 0.5])], "token string, vec array<float>")
    docs = spark.createDataFrame([(i,) for i in range(42)], "doc_id long")
    got = lambda: {r.doc_id: [round(x, 9) for x in r.vec] if r.vec else None for r in vectors.doc_vectors(df, table, docs=docs).collect()}
    want = got()
    written, real = [], session.materialize
    monkeypatch.setattr(session, "materialize", lambda x, name: written.append(name) or real(x, name))
    monkeypatch.setattr(vectors, "BLOCK_PAIRS", 9)
    monkeypatch.setattr(vectors, "WAVES", 5)
    assert got() == want and written.count("doc-means") == 5 and len(want) == 42 and want[41] is None


def test_vector_vocabulary_is_that_of_the_expression(spark, tmp_path):
    """Words found on the bytes of a batch are those of the regular expression on the lower-cased text; no row is a word of a text."""
    from reviewspark.sources.vectors import vector_vocabulary
    texts = ["Ab cd", "ef", None, "", "x9y-z", "\u0130stanbul \u212Aelvin na\u00efve", "end", "start.", "\U0001f600a", "a" * 40_000, "..", "End", "q"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    got = vector_vocabulary(spark, str(tmp_path))
    want = spark.read.parquet(f"{tmp_path}/documents.parquet").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0)).alias("token")).distinct()
    assert sorted(r.token for r in got.collect()) == sorted(r.token for r in want.collect())
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
