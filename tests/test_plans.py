"""Plan checks: no Python on the relational path, pruning reaches the scan,
and the flagship entry point runs."""

import pytest

from reviewspark.catalog import QUERIES, load_all

from conftest import SF001

RELATIONAL = ["clean_sentence", "clean_tokens", "tfidf", "encode_freq", "pad_pre", "doc_vectors", "ngrams",
              "split_bucket", "stratified_folds", "roc_auc", "subsample_words", "most_similar", "decode"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_python_udf(spark, name):
    load_all()
    plan = _plan(QUERIES[name](spark, SF001))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_prunes_columns(spark):
    load_all()
    plan = _plan(QUERIES["split_bucket"](spark, SF001))
    assert "ReadSchema: struct<doc_id:bigint>" in plan


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["doc_id", "token", "w", "rank"]
    assert set(E.oracle_sql()) <= set(E.queries())
