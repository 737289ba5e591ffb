"""File sources: line files, labelled line pairs, tab-separated reviews.

Explicit schemas everywhere (no inference).  Where file order matters
(line numbers, "last line wins"), the order key is
``(file path, split start, monotonically_increasing_id)``: rows of one split
are read in order, so the key follows the file without a driver-side pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import clean_sentence, strip_line
from ..operators.joins import fits
from ..session import materialize

REVIEW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("sentiment", T.IntegerType()),
    T.StructField("review", T.StringType()),
])
TEST_REVIEW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("review", T.StringType()),
])


def with_line_order(df: DataFrame) -> DataFrame:
    """Add ``_file``, ``_start``, ``_row``: a sort key that follows file order."""
    return (df.withColumn("_file", F.col("_metadata.file_path"))
              .withColumn("_start", F.col("_metadata.file_block_start"))
              .withColumn("_row", F.monotonically_increasing_id()))


def read_lines(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """One row per line, stripped of surrounding whitespace: ``(text)``; with
    ``numbered`` also a 1-based ``line_no`` in file order.

    The lines of a split are in order where they are read, so only the number of lines per split is counted: one
    row a split, whose running total over (file, start) gives every split the number of its first line.  That narrow
    table is joined back (broadcast if measured to be small); the texts do not move.
    """
    df = spark.read.text(path)
    if not numbered:
        return df.select(strip_line("value").alias("text"))
    ordered = with_line_order(df)
    # the same files are cut into the same splits and tasks, so the row numbers of both readings agree
    splits = ordered.groupBy("_file", "_start").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(F.col("_file").alias("_f"), F.col("_start").alias("_s"),
                            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    offsets = materialize(offsets, "line-offsets")
    table = F.broadcast(offsets) if fits(offsets) else offsets
    numbered_ = ordered.join(table, (F.col("_file") == F.col("_f")) & (F.col("_start") == F.col("_s")))
    return numbered_.select((F.col("_row") + F.col("_shift") + 1).alias("line_no"), strip_line("value").alias("text"))


def pos_neg_source(pos: DataFrame, neg: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Two sources -> one table with label 1 (positive) / 0 (negative), text
    normalised by the sentence cleaner.  ``(doc_id, text, label)``."""
    both = (pos.select(key, text).withColumn("label", F.lit(1))
            .unionByName(neg.select(key, text).withColumn("label", F.lit(0))))
    return both.select(key, clean_sentence(text).alias("text"), F.col("label").cast("int"))


def read_pos_neg_files(spark: SparkSession, pos_path: str, neg_path: str) -> DataFrame:
    """Line files as the two sources; ``doc_id`` = positive lines first, then
    negative lines, in file order (1-based)."""
    pos = read_lines(spark, pos_path, numbered=True)
    neg = read_lines(spark, neg_path, numbered=True)
    n_pos = pos.select(F.count(F.lit(1))).scalar()
    pos = pos.select(F.col("line_no").alias("doc_id"), "text")
    neg = neg.select((F.col("line_no") + n_pos).alias("doc_id"), "text")
    return pos_neg_source(pos, neg)


def label_code(name_col) -> "F.Column":
    """Label name -> code: ``pos`` -> 1, ``neg`` -> 0."""
    c = F.col(name_col) if isinstance(name_col, str) else name_col
    return F.when(c == "pos", 1).when(c == "neg", 0).cast("int")


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = REVIEW_SCHEMA) -> DataFrame:
    """Tab-separated file with a header and quoting off: stray ``"`` characters
    stay verbatim in every field."""
    return (spark.read.option("sep", "\t").option("header", True).option("quote", "")
            .option("escape", "").option("mode", "PERMISSIVE").schema(schema).csv(path))
