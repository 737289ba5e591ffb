"""A hot key holding a third of all rows: results stay exact and whole, and
the plans combine map-side before shuffling."""

from collections import Counter

from pyspark.sql import functions as F

from reviewspark.operators import weights as Wt
from reviewspark.operators.vocab import vocab_freq
from reviewspark.operators.encode import encode_drop_oov
from reviewspark.functions import tokens as T


def _skewed(spark, n_docs=300):
    rows = []
    for d in range(n_docs):
        words = ["hot"] * 20 + [f"w{(d * 7 + i) % 97}" for i in range(40)]
        rows.append((d, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(6), rows


def test_hot_token_vocab_and_tfidf_exact(spark):
    df, rows = _skewed(spark)
    long = df.select("doc_id", F.posexplode(T.whitespace_split("text")).alias("pos", "token"))
    counts = Counter(w for _, t in rows for w in t.split())
    assert counts["hot"] * 3 == sum(counts.values())          # one third of all rows
    vocab = {r.token: (r.n, r.idx) for r in vocab_freq(long).collect()}
    assert vocab["hot"] == (counts["hot"], 1)
    assert len(vocab) == len(counts)
    _, _, w = Wt.fit_transform_tfidf(long, df)
    got = w.where("token = 'hot'").count()
    assert got == len(rows)                                    # every document keeps its hot-token weight


def test_partial_aggregation_before_shuffle(spark):
    df, _ = _skewed(spark)
    long = df.select("doc_id", F.posexplode(T.whitespace_split("text")).alias("pos", "token"))
    plan = long.groupBy("token").count()._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_capped_vocab_is_broadcast_and_whole(spark):
    df, rows = _skewed(spark)
    long = df.select("doc_id", F.posexplode(T.whitespace_split("text")).alias("pos", "token"))
    vocab = vocab_freq(long)
    enc = encode_drop_oov(df, T.whitespace_split("text"), vocab, cap=1000)
    plan = enc._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    lens = {r.doc_id: len(r.seq) for r in enc.collect()}
    assert all(lens[d] == 60 for d, _ in rows)


def test_skew_split_join_equals_plain_join(spark):
    from reviewspark.operators.joins import skew_split_join
    big = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(3000)],
                                "id long, token string")
    small = spark.createDataFrame([("hot", 1.5)] + [(f"k{j}", float(j)) for j in range(0, 50, 2)],
                                  "token string, v double")
    counts = big.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    got = skew_split_join(big, small, "token", counts, max_hot=10)
    want = big.join(small, "token")
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_checked_broadcast_within_and_beyond_budget(spark):
    from reviewspark.operators.joins import fits, lookup, measured
    big = spark.range(1000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("token"))
    small = spark.createDataFrame([(str(i), i) for i in range(7)], "token string, idx long")
    assert measured(small)[0] == 7 and fits(small, 10)
    assert not fits(small, 5) and not fits(small, 10, max_bytes=8)
    inside = lookup(big, small, "token", check=True, max_rows=10)
    assert "BroadcastHashJoin" in inside._jdf.queryExecution().sparkPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        beyond = lookup(big, small, "token", check=True, max_rows=5)
        assert "BroadcastHashJoin" not in beyond._jdf.queryExecution().sparkPlan().toString()
        assert beyond.count() == inside.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
