"""A fast slice of the oracle gate inside pytest: Spark query vs its DuckDB
twin on sf0.001 (tools/oracle_check.py runs all of them on sf0.01)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

from conftest import SF001

FAST = ["clean_sentence", "strip_html", "clean_tokens", "tok_freq", "vocab_freq", "vocab_first_seen",
        "encode_freq", "pad_pre", "tfidf", "idf", "split_exact", "stratified_folds", "roc_auc",
        "describe_words", "embedding_matrix", "most_similar", "prepare_train_val", "sentences"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _dnorm(v):
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        v = v.item()
    return _norm(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", FAST)
def test_matches_sql(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    ddf = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(ddf.columns) == cols
    drows = sorted((tuple(_dnorm(r[c]) for c in cols) for _, r in ddf.iterrows()), key=repr)
    assert srows == drows
