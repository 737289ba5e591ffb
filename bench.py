"""Time the headline queries on one scale factor; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion through the ``noop`` sink (full execution, no
collect); the first query also pays for JVM warm-up, so a throwaway warm-up
query runs first.  The test tables are files of one row group, which Spark reads in one task; the bench
first writes them as several files, as a large table would be, outside the timed part.  What a query wrote
is deleted before the next one.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewspark.catalog import QUERIES, load_all  # noqa: E402
from reviewspark.session import build_session, release_intermediates  # noqa: E402

HEADLINE = [
    "clean_sentence", "clean_tokens", "tfidf", "top_terms", "ngrams", "vocab_freq", "encode_freq",
    "pad_pre", "prepare_train_val", "sentence_corpus", "doc_vectors", "embedding_matrix",
    "subsample_words", "stratified_folds", "roc_auc", "describe_words", "split_exact", "downsample",
    "tokens_no_stop", "decode", "most_similar", "svm_accuracy", "rbf_svm_predict", "word2vec_fit",
    "fit_history",
]
TABLES = ["documents", "pages", "labels", "embeddings"]  # what the headline queries read


def spread_copy(spark, sf_dir, cpus):
    out = tempfile.mkdtemp(prefix="bench-input-")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(2 * cpus).write.parquet(f"{out}/{name}.parquet")
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    load_all()
    names = [a for a in sys.argv[1:]] or HEADLINE
    for warm in ("clean_sentence", "tfidf", "encode_freq"):  # JIT warm-up on the smallest tables
        QUERIES[warm](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    source = spread_copy(spark, sf_dir, cpus)
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, source).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        release_intermediates(spark)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
