"""Shuffle -> downsample -> first-seen vocabulary -> encode -> pad -> one-hot
-> tail split, as one declarative plan.

The vocabulary is fitted on all sampled texts before the split by default
(the original behaviour); ``fit_on='train'`` fits it on training rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import tokens as T
from ..functions.clean import clean_review
from ..functions.fixed import MAX_SEQUENCE_LENGTH, SEED, VALIDATION_SPLIT
from ..operators.encode import encode_oov_zero
from ..operators.ranking import dense_index
from ..operators.joins import lookup
from ..operators.splits import downsample, shuffle_order
from ..operators.vocab import vocab_first_seen
from ..session import materialize


def prepare_train_val(docs: DataFrame, train_size: int = 1000, seed=SEED, max_len: int = MAX_SEQUENCE_LENGTH,
                      val_frac: float = VALIDATION_SPLIT, fit_on: str = "all"):
    """``docs(doc_id, text, label)`` -> ``(doc_id, rank, split, label, onehot, x)``
    plus the vocabulary ``(token, idx)``.

    ``rank`` is the seeded shuffle position; the first ``train_size`` ranks are
    kept and the last ``int(val_frac * n)`` of them validate.
    """
    # pick the sample on the key column alone (prefix-filtered top-n), rank
    # those <= train_size keys, and join them back: the bound is the
    # parameter, so the keys are broadcast
    keys = downsample(docs.select("doc_id"), train_size, seed)
    ranked_keys = dense_index(keys, shuffle_order(seed), name="rank")
    picked = lookup(docs, ranked_keys, "doc_id", "inner", bound_rows=train_size)
    sample = picked.select("doc_id", "rank", clean_review("text").alias("text"), F.col("label").cast("int"))
    n = sample.select(F.count(F.lit(1))).scalar()
    n_val = F.floor(F.lit(float(val_frac)) * n)
    sample = sample.withColumn("split", F.when(F.col("rank") > n - n_val, "val").otherwise("train"))
    # the sample's tokens (``train_size`` documents) are written once; vocabulary and encoding read them
    sample = materialize(sample.select("doc_id", "rank", "label", "split", T.clean_tokens("text").alias("tk")), "sample-tokens")
    tokens = F.col("tk")
    fit_rows = sample if fit_on == "all" else sample.where(F.col("split") == "train")
    long = fit_rows.select("rank", F.posexplode(tokens).alias("pos", "token"))
    vocab = vocab_first_seen(long, doc_order="rank")
    enc = encode_oov_zero(sample, tokens, vocab, max_len=max_len, carry=("rank", "split", "label"))
    out = enc.select("doc_id", "rank", "split", "label", A.one_hot("label", 2).alias("onehot"),
                     A.pad_post("seq", max_len).alias("x"))
    return out, vocab
