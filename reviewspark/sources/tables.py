"""Bindings of the reference's inputs to the given Parquet tables.

| reference input            | binding                                              |
|----------------------------|------------------------------------------------------|
| positive / negative lines  | ``documents JOIN labels``; label = ``quality``       |
| labelled review TSV        | same join (``id`` = ``doc_id``)                      |
| unlabelled reviews         | ``documents LEFT ANTI JOIN labels``                  |
| HTML reviews               | ``pages.html``                                       |
| pretrained vectors         | ``embeddings`` bound to tokens (``sources.vectors``) |

Reads select only the needed columns so the Parquet scan prunes the rest
(``text`` / ``html`` are the heavy columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


def labelled_documents(spark: SparkSession, sf_dir: str, label: str = "quality") -> DataFrame:
    """``(doc_id, text, label)``: the labelled review table.

    ``labels`` is joined on the unique ``doc_id``; AQE broadcasts it when its
    measured size is small and otherwise keeps a sort-merge join.
    """
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", label).withColumnRenamed(label, "label")
    return docs.join(labels, "doc_id").select("doc_id", "text", F.col("label").cast("int").alias("label"))


def unlabelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id")
    return docs.join(labels, "doc_id", "left_anti")


def language_target(spark: SparkSession, sf_dir: str, lang: str = "en") -> DataFrame:
    """``(doc_id, text, label)`` with the learnable target ``label = (lang = 'en')``.

    ``quality`` is 85 % one class and carries no signal a linear model can
    learn; model checks use this target and always report the majority rate.
    """
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    return docs.select("doc_id", "text", (F.col("lang") == lang).cast("int").alias("label"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages", "page_id", "html")
