"""Trained sentence boundaries, mergeable sketches and line numbers."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewspark.operators import sentences as Sn
from reviewspark.operators import sketches as Sk
from reviewspark.sources import text as Tx

WORDS = "film story actor scene plot director camera music ending hero villain script picture screen".split()
STARTS = "The It He They This".split()


def planted(n=400, seed=1):
    """Texts of known sentences with planted abbreviations in the middle, some followed by a capital name."""
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        sentences = []
        for _ in range(rng.randrange(2, 7)):
            w = [rng.choice(STARTS)] + [rng.choice(WORDS) for _ in range(rng.randrange(4, 12))]
            k = rng.randrange(1, len(w))
            w[k:k] = rng.choice([[], ["mr.", rng.choice(["Smith", "Jones", "Brown"])], ["e.g."], ["approx.", "3"], ["etc."], ["J.", "Miller"]])
            sentences.append(" ".join(w) + rng.choice([".", ".", ".", "!", "?", '."']))
        docs.append((i, sentences))
    return docs


@pytest.fixture(scope="module")
def corpus(spark):
    docs = planted()
    return docs, spark.createDataFrame([(i, "  ".join(s)) for i, s in docs], "doc_id long, text string").repartition(3)


def test_planted_abbreviations_are_learned(corpus):
    _, df = corpus
    found = {r.word: r for r in Sn.abbreviations(Sn.word_pairs(df)).collect()}
    assert {"mr", "e.g", "approx", "etc"} <= set(found) and not set(found) & set(WORDS)
    texts = [r.text for r in df.collect()]
    assert found["mr"].n_stop == sum(t.split().count("mr.") for t in texts) and found["mr"].n_plain == 0


def test_scores_are_those_of_the_formula(corpus):
    _, df = corpus
    import re
    stop, plain = {}, {}
    for r in df.collect():
        for w in r.text.split():
            c = re.sub(Sn.AROUND, "", w).lower()
            b = re.sub(r"\.+$", "", c)
            if re.search("[a-z]", b):
                d = stop if c.endswith(".") else plain
                d[b] = d.get(b, 0) + 1
    n, s = sum(stop.values()) + sum(plain.values()), sum(stop.values())
    xlogy = lambda x, y: x * math.log(y) if x else 0.0
    want = {}
    for b, k in stop.items():
        p = plain.get(b, 0)
        inner = b.count(".")
        ratio = -2 * (xlogy(k, s / n) + xlogy(p, 1 - s / n) - xlogy(k, 0.99) - xlogy(p, 0.01))
        score = ratio * math.exp(-(len(b) - inner)) * (inner + 1) * (len(b) - inner) ** -p
        if score >= Sn.ABBREVIATION:
            want[b] = score
    got = {r.word: r.score for r in Sn.abbreviations(Sn.word_pairs(df)).collect()}
    assert set(got) == set(want) and all(got[b] == pytest.approx(want[b]) for b in want)


def test_sentences_end_where_they_were_planted(corpus):
    docs, df = corpus
    got = {}
    for r in Sn.trained_sentences(df).orderBy("doc_id", "sent_no").collect():
        got.setdefault(r.doc_id, []).append(r.sentence)
    right = sum(got[i] == s for i, s in docs)
    rule_based = sum(len(s) == sum(w[-1] in ".!?" or w[-1] == '"' for t in s for w in t.split()) for _, s in docs)
    assert right >= 0.95 * len(docs) > rule_based
    for i, s in docs:  # nothing is lost or added
        assert " ".join(got[i]).split() == " ".join(s).split()


def test_sentences_of_odd_texts(spark, corpus):
    learned = Sn.learn(corpus[1])
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "no end"), (5, "..."), (6, "One.\nTwo"), (7, "3. floor of mr. X. The end. " * 3000)]
    got = Sn.trained_sentences(spark.createDataFrame(rows, "doc_id long, text string"), learned=learned).collect()
    by = {}
    for r in sorted(got):
        by.setdefault(r.doc_id, []).append(r.sentence)
    assert by[4] == ["no end"] and by[5] == ["..."] and by[6] == ["One.", "Two"] and not {1, 2, 3} & set(by)
    # "X." is an initial: a sentence ends behind it because "The" starts sentences
    assert by[7][:2] == ["3. floor of mr. X.", "The end."] and len(by[7]) == 6000


def test_long_lists_are_used_whole(spark, corpus):
    """Lists beyond the size of a literal give the same sentences; rows of one id or without one stay apart."""
    _, df = corpus
    rows = df.unionByName(df.limit(3)).unionByName(spark.createDataFrame([(None, "So mr. Smith sat. The end came."), (None, None), (900, "")], df.schema))
    rows = spark.createDataFrame(rows.collect(), df.schema)
    want = sorted(map(str, Sn.trained_sentences(rows, learned=Sn.learn(df)).collect()))
    learned = Sn.learn(df, most=1)
    assert all(hasattr(x, "columns") and x.count() > 1 for x in learned)
    assert sorted(map(str, Sn.trained_sentences(rows, learned=learned).collect())) == want


# ---- sketches ------------------------------------------------------------------


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.lognormal(5, 1, 30000), np.full(10000, 42.0)])   # a value in a quarter of all rows
    return x, spark.createDataFrame([(float(v), int(i % 7), f"w{int(v) % 5000}") for i, v in enumerate(x)], "x double, part int, item string")


def test_numbers_within_the_stated_bounds(numbers):
    x, df = numbers
    r = Sk.merged_numbers(Sk.number_profile(df, "x", "part")).first()
    assert r["count"] == len(x) and r["min"] == x.min() and r["max"] == x.max()
    assert r["mean"] == pytest.approx(x.mean()) and r["std"] == pytest.approx(x.std(ddof=1))
    for p, c in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        assert (x < r[c]).mean() - Sk.RANK_ERROR <= p <= (x <= r[c]).mean() + Sk.RANK_ERROR


def test_items_within_the_stated_bounds(numbers):
    x, df = numbers
    n = df.select("item").distinct().count()
    r = Sk.merged_items(Sk.item_profile(df, "item", "part")).first()
    assert r.n == len(x) and abs(r.n_distinct - n) <= Sk.DISTINCT_ERROR * n


def test_extending_equals_rebuilding(spark, numbers, tmp_path):
    x, df = numbers
    path = str(tmp_path / "items")
    Sk.extend(Sk.item_profile(df.where("part < 3"), "item", "part"), path)
    Sk.extend(Sk.item_profile(df.where("part >= 3"), "item", "part"), path)
    a, b = Sk.merged_items(Sk.stored(spark, path)).first(), Sk.merged_items(Sk.item_profile(df, "item", "part")).first()
    n = df.select("item").distinct().count()
    assert a.n == b.n == len(x) and all(abs(r.n_distinct - n) <= Sk.DISTINCT_ERROR * n for r in (a, b))
    path = str(tmp_path / "numbers")
    Sk.extend(Sk.number_profile(df.where("part < 3"), "x", "part"), path)
    Sk.extend(Sk.number_profile(df.where("part >= 3"), "x", "part"), path)
    a, b = Sk.merged_numbers(Sk.stored(spark, path)).first(), Sk.merged_numbers(Sk.number_profile(df, "x", "part")).first()
    assert (a["count"], a["min"], a["max"]) == (b["count"], b["min"], b["max"]) and a["std"] == pytest.approx(b["std"])
    for c, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert (x < a[c]).mean() - Sk.RANK_ERROR <= p <= (x <= a[c]).mean() + Sk.RANK_ERROR


def test_sketches_of_nothing(spark):
    none = spark.createDataFrame([], "x double, part int, item string")
    r = Sk.merged_numbers(Sk.number_profile(none, "x", "part")).first()
    assert r["count"] == 0 and r["mean"] is None and r["p50"] is None
    assert Sk.merged_items(Sk.item_profile(none, "item", "part")).first() == (0, 0)
    nulls = spark.createDataFrame([(None, 1, None), (None, 2, None), (3.0, 2, "a")], "x double, part int, item string")
    r = Sk.merged_numbers(Sk.number_profile(nulls, "x", "part")).first()
    assert r["count"] == 1 and r["p50"] == 3.0 and r["std"] is None


def test_word_profile_is_near_the_exact_queries(spark):
    from reviewspark.plans import eval_queries, vocab_queries
    sf = "/root/testdata/sf0.01"
    got, exact = eval_queries.q_word_profile(spark, sf).first(), eval_queries.q_describe_words(spark, sf).first()
    assert got["count"] == exact["count"] and got["min"] == exact["min"] and got["max"] == exact["max"]
    assert got["mean"] == pytest.approx(exact["mean"], abs=1e-5) and got["std"] == pytest.approx(exact["std"], abs=1e-5)
    n = vocab_queries.q_distinct_tokens(spark, sf).first().n_tokens
    assert abs(got.distinct_tokens - n) <= Sk.DISTINCT_ERROR * n


# ---- line numbers ---------------------------------------------------------------


def test_lines_are_numbered_over_files_and_splits(spark, tmp_path):
    rng, want = random.Random(4), []
    for name in ("a.txt", "b.txt", "c.txt"):
        lines = [f"{name} {k} " + "x" * rng.randrange(0, 90) for k in range(rng.randrange(2000, 4000))]
        want += [w.strip() for w in lines]
        with open(os.path.join(tmp_path, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        df = Tx.read_lines(spark, str(tmp_path), numbered=True)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = [r.text for r in sorted(df.collect(), key=lambda r: r.line_no)]
        assert got == want and [r for r in sorted(x.line_no for x in df.collect())] == list(range(1, len(want) + 1))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan
    finally:
        for k, v in zip(("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"), before):
            spark.conf.set(k, v)
