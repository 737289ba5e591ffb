"""Row-local operators on Structured Streaming.

Cleaning, tokenising, encoding against a fitted (static) vocabulary and
model scoring touch one row at a time, so the same Column / DataFrame
functions run unchanged on a stream.  ``run_available_now`` processes
everything available (``trigger(availableNow=True)``) into a Parquet sink
with its checkpoint in the shared folder, which makes the run restartable
after a failure (exactly-once file sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tokens as T
from ..functions.clean import clean_sentence

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def document_stream(spark: SparkSession, folder: str, schema: str = DOC_SCHEMA, glob: str | None = None,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving in ``folder`` (optionally only names matching ``glob``)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def table_stream(spark: SparkSession, sf_dir: str, name: str = "documents", schema: str = DOC_SCHEMA) -> DataFrame:
    """A given table as a file stream, whether ``<name>.parquet`` is one file or a folder of part files.

    The path is a pattern that only this name matches: a stream's plain path must be a folder, and a filter on file
    names would miss the parts of a folder.
    """
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/[{name[0]}]{name[1:]}.parquet")


def clean_and_count(stream: DataFrame) -> DataFrame:
    """``(doc_id, text, n_tokens)``: normalised text and its token count."""
    text = clean_sentence("text")
    return stream.select("doc_id", text.alias("text")).withColumn("n_tokens", F.size(T.word_tokens("text")))


def run_available_now(df: DataFrame, sink_path: str, checkpoint_path: str) -> None:
    q = (df.writeStream.format("parquet").option("path", sink_path)
         .option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).outputMode("append").start())
    q.awaitTermination()


def run_batches_available_now(stream: DataFrame, per_batch, sink_path: str, checkpoint_path: str) -> None:
    """Apply a batch function to every micro-batch (``foreachBatch``) and write
    its result under ``sink_path/batch_id=<id>`` with overwrite, so a retried
    batch replaces its own output (idempotent, exactly-once with the
    checkpoint).  Lets per-batch shuffles (an encode's regroup by document,
    whose rows all arrive in the same batch) run without streaming state."""

    def handle(batch_df, batch_id):
        per_batch(batch_df).write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
