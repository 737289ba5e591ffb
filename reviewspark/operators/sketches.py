"""Mergeable summaries: stored per part of a table, extended by new rows only, merged when asked.

``describe`` and ``countDistinct`` read everything again for every answer.  Here each part of a table (a day, a load, a
source) leaves one narrow row: count, sum, sum of squares, smallest and largest value, a KLL quantile sketch, an HLL
sketch of its items.  New data add rows; no old text is read again.  The merged answer is one small aggregate.

Count, mean, deviation, smallest and largest value are exact.  Quantiles are right within ``RANK_ERROR`` of the rank,
distinct counts within ``DISTINCT_ERROR`` (three standard errors); both bounds hold for merged sketches as for one made of
all rows at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KLL_K, HLL_LG_K = 800, 14
RANK_ERROR = 0.01
DISTINCT_ERROR = 3 * 1.04 / 2 ** (HLL_LG_K / 2)


def number_profile(df: DataFrame, value: str, part: str) -> DataFrame:
    """One row a part: part, n, total, squares, low, high, quantiles (binary).  Null values are not counted."""
    v = F.col(value).cast("double")
    return df.groupBy(F.col(part).cast("string").alias("part")).agg(
        F.count(v).alias("n"), F.sum(v).alias("total"), F.sum(v * v).alias("squares"), F.min(v).alias("low"),
        F.max(v).alias("high"), F.kll_sketch_agg_double(v, F.lit(KLL_K)).alias("quantiles"))


def item_profile(df: DataFrame, item: str, part: str) -> DataFrame:
    """One row a part: part, n, items (binary sketch of the different items)."""
    return df.groupBy(F.col(part).cast("string").alias("part")).agg(
        F.count(item).alias("n"), F.hll_sketch_agg(F.col(item), F.lit(HLL_LG_K)).alias("items"))


def extend(profile: DataFrame, path: str) -> None:
    """Add the profile of new rows to a stored one."""
    profile.write.mode("append").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged_numbers(profile: DataFrame) -> DataFrame:
    """count, mean, std (sample), min, p25, p50, p75, max over all parts."""
    # a part without values has no sketch to give
    some = profile.where("n > 0")
    all_ = some.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.sum("total").alias("t"), F.sum("squares").alias("s"),
                    F.min("low").alias("min"), F.max("high").alias("max"), F.kll_merge_agg_double("quantiles").alias("q"))
    n = F.col("count").cast("double")
    var = (F.col("s") - F.col("t") * F.col("t") / n) / (n - 1.0)
    at = lambda p: F.when(n > 0, F.kll_sketch_get_quantile_double("q", F.lit(p)))
    return all_.select("count", F.when(n > 0, F.col("t") / n).alias("mean"),
                       F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).alias("std"), "min", at(0.25).alias("p25"),
                       at(0.5).alias("p50"), at(0.75).alias("p75"), "max")


def merged_items(profile: DataFrame) -> DataFrame:
    """n and the estimated number of different items over all parts."""
    return profile.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                       F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("items")), F.lit(0)).alias("n_distinct"))
