"""Linear text classifiers as Spark ML pipelines: for models to be saved and loaded, and for searches over many small
fits.  ``ml.span`` fits one model, or a few together, without a dense vector.

Tokens come from built-in expressions (the same cleaning and tokenising as
the relational operators); counting, idf, normalising and the solvers are
JVM stages.  ``SmoothIdf`` is the one custom stage: Spark's ``IDF`` computes
``ln((m+1)/(df+1))`` while the smooth idf used by the tf-idf operators adds
``+1``; it fits the built-in ``IDF`` and returns the built-in
``ElementwiseProduct`` scaled by ``idf + 1`` (no UDF).
"""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import clean_sentence
from ..functions.tokens import ngram_range, word_tokens


class _Identity(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df):
        return df.withColumn(self.getOutputCol(), F.col(self.getInputCol()))


class SmoothIdf(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator: term-frequency vector -> tf x (ln((1+n)/(1+df)) + 1).

    ``useIdf=False`` passes term frequencies through unchanged.
    """

    useIdf = Param(Params._dummy(), "useIdf", "weight by smooth idf", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, useIdf=True):
        super().__init__()
        self._setDefault(useIdf=True)
        kwargs = self._input_kwargs
        self._set(**kwargs)

    def _fit(self, df: DataFrame):
        if not self.getOrDefault(self.useIdf):
            return _Identity(self.getInputCol(), self.getOutputCol())
        model = IDF(inputCol=self.getInputCol(), outputCol="_idf_tmp").fit(df)
        scale = DenseVector(np.asarray(model.idf.toArray()) + 1.0)
        return ElementwiseProduct(scalingVec=scale, inputCol=self.getInputCol(), outputCol=self.getOutputCol())


def with_token_columns(df: DataFrame, text: str = "text", ngram_hi: int = 1) -> DataFrame:
    """Add ``tokens`` (count-vectoriser tokens of the normalised text) and,
    with ``ngram_hi > 1``, ``grams`` (all 1..ngram_hi word n-grams)."""
    out = df.withColumn("tokens", word_tokens(clean_sentence(text)))
    if ngram_hi > 1:
        out = out.withColumn("grams", ngram_range(F.col("tokens"), 1, ngram_hi))
    return out


def sparse_vectors(rows: DataFrame, docs: DataFrame, size: int, value: str, name: str, key: str = "doc_id") -> DataFrame:
    """``docs`` with a sparse vector column ``name`` from ``rows(doc_id, idx, value)``; no rows: the zero vector.

    One document's terms meet in one row (bounded by the distinct terms of one text); the per-row function only
    packs them.
    """
    from pyspark.ml.linalg import SparseVector, VectorUDT
    pack = F.udf(lambda i, v: SparseVector(size, i or [], v or []), VectorUDT())
    per = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("idx", F.col(value).cast("double").alias("x")))).alias("_t"))
    ids = F.transform("_t", lambda t: t["idx"].cast("int"))
    return (docs.join(per, key, "left").withColumn(name, pack(ids, F.transform("_t", lambda t: t["x"]))).drop("_t"))


def counted_features(docs: DataFrame, text: str = "text", ngram_hi: int = 1, fit: str = "split = 'train'"):
    """``(features table, vocabulary size)``: term counts ``tf`` as sparse vectors on the counted vocabulary.

    The vocabulary is every 1..``ngram_hi``-gram of the rows that ``fit`` selects, indexed by the distributed
    alphabetical rank: no hashing, no cap, nothing on the driver but its size.  Counts are written once; terms
    outside the vocabulary drop out of the other rows.  Hot terms are joined apart.
    """
    from ..operators.vocab import vocab_alpha
    from ..operators.weights import split_join
    from ..session import materialize
    grams = ngram_range(F.col("_tk"), 1, ngram_hi) if ngram_hi > 1 else F.col("_tk")
    keep = [c for c in docs.columns if c != text]
    long = (docs.withColumn("_tk", word_tokens(clean_sentence(text))).select(*keep, F.explode(grams).alias("token")))
    tf = materialize(long.groupBy(*keep, "token").agg(F.count(F.lit(1)).alias("tf")), "counted-tf")
    vocab = materialize(vocab_alpha(tf.where(fit).select("token")), "counted-vocab")
    size = max(1, vocab.count())
    rows = split_join(tf, vocab)
    table = sparse_vectors(rows, docs.select(*keep), size, "tf", "tf")
    return materialize(table, "counted-features"), size


def solver_stages(reg_param: float = 1e-3, use_idf: bool = True, input_col: str = "tf"):
    """Smooth idf (fitted on the training rows) -> L2 normaliser, over a count vector column."""
    return [SmoothIdf(inputCol=input_col, outputCol="tfidf", useIdf=use_idf),
            Normalizer(inputCol="tfidf", outputCol="features", p=2.0)]


def svm(reg_param: float = 1e-3, max_iter: int = 20) -> LinearSVC:
    """``aggregationDepth`` 3: wide gradients are summed in a deeper tree, not all at the driver."""
    return LinearSVC(featuresCol="features", labelCol="label", regParam=reg_param, maxIter=max_iter,
                     standardization=False, aggregationDepth=3)


def text_features(input_col: str = "tokens", use_idf: bool = True):
    """Stages for a saved pipeline over token arrays: counts -> smooth idf -> L2 normaliser.

    ``CountVectorizer`` holds its vocabulary on the driver and keeps the 4,194,304 most frequent terms at most;
    ``ml.span``, which the model queries use, has neither limit."""
    return [CountVectorizer(inputCol=input_col, outputCol="tf", vocabSize=1 << 22, minDF=1.0),
            SmoothIdf(inputCol="tf", outputCol="tfidf", useIdf=use_idf),
            Normalizer(inputCol="tfidf", outputCol="features", p=2.0)]


def svm_pipeline(reg_param: float = 1e-3, max_iter: int = 20, input_col: str = "tokens"):
    """tokens -> counts -> tf-idf -> linear SVM (hinge loss, L2)."""
    svm = LinearSVC(featuresCol="features", labelCol="label", regParam=reg_param, maxIter=max_iter,
                    standardization=False)
    return Pipeline(stages=text_features(input_col) + [svm])


def logreg_pipeline(reg_param: float = 1e-3, max_iter: int = 50, input_col: str = "tokens"):
    lr = LogisticRegression(featuresCol="features", labelCol="label", regParam=reg_param, maxIter=max_iter)
    return Pipeline(stages=text_features(input_col) + [lr])


def margin(col: str = "rawPrediction"):
    """Signed margin of the positive class from a raw prediction vector."""
    from pyspark.ml.functions import vector_to_array
    return F.element_at(vector_to_array(F.col(col)), 2)


def positive_probability(col: str = "probability"):
    from pyspark.ml.functions import vector_to_array
    return F.element_at(vector_to_array(F.col(col)), 2)
