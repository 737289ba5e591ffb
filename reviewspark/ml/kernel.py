"""Kernel SVM, re-aimed: random Fourier features (Rahimi & Recht, 2007)
approximate an RBF kernel ``exp(-gamma |x - y|^2)``, a linear SVM is fitted
on them, and a one-feature logistic regression on the margin turns scores
into probabilities (Platt scaling).

The feature map is an Arrow-batched pandas UDF (a numpy matmul per batch);
its only state is the ``dim x D`` projection, a bounded closure.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fourier_map(dim: int, n_features: int = 256, gamma: float = 1.0, seed: int = 42):
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(dim, n_features))
    b = rng.uniform(0.0, 2.0 * np.pi, size=n_features)
    scale = np.sqrt(2.0 / n_features)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def rff(vecs: pd.Series) -> pd.Series:
        if len(vecs) == 0:
            return pd.Series([], dtype=object)
        x = np.vstack([np.asarray(v, dtype=np.float64) for v in vecs])
        z = scale * np.cos(x @ w + b)
        return pd.Series(list(z))

    return rff


def fit_rbf_svm(train: DataFrame, dim: int, vec: str = "vec", label: str = "label",
                n_features: int = 256, gamma: float = 1.0, reg_param: float = 1e-3, seed: int = 42, key: str = "doc_id"):
    """Returns a function ``DataFrame -> DataFrame`` adding ``margin``,
    ``prob`` and ``prediction``."""
    rff = fourier_map(dim, n_features, gamma, seed)

    def feats(df):
        return df.withColumn("features", array_to_vector(rff(F.col(vec))))

    from ..functions.hashing import md5_bucket
    from ..session import materialize
    # mapped once and read back: the solver iterates over it.  A fifth of the rows is held out of the SVM's fit and
    # gives the margins that the probabilities are fitted on.
    held = md5_bucket("platt", key, 100) < 20
    mapped = materialize(feats(train).select(label, "features", held.alias("held")), "rff-train")
    svm = LinearSVC(labelCol=label, regParam=reg_param, maxIter=50, standardization=False).fit(mapped.where("not held"))

    def margins(df):
        out = svm.transform(df)
        return out.withColumn("margin", F.element_at(vector_to_array("rawPrediction"), 2))

    def with_margin(df):
        return margins(feats(df))

    platt_in = (margins(mapped.where("held")).drop("rawPrediction", "prediction", "features")
                .withColumn("m", array_to_vector(F.array("margin"))))
    platt = LogisticRegression(featuresCol="m", labelCol=label, regParam=0.0).fit(platt_in)

    def predict(df):
        m = (with_margin(df).drop("rawPrediction", "prediction", "features")
             .withColumn("m", array_to_vector(F.array("margin"))))
        p = platt.transform(m)
        return p.select(*df.columns, "margin",
                        F.element_at(vector_to_array("probability"), 2).alias("prob"),
                        F.col("prediction").cast("int").alias("prediction"))

    return predict
