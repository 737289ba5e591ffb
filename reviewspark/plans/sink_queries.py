"""File sources and sinks, checked by a round trip: data derived from the
given tables is written to the shared folder with one operator and read back
with its counterpart; the SQL twins see the values that come back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..functions import tokens as T
from ..operators.tokens import sentence_corpus
from ..session import materialize, shared_path
from ..sinks import writers as Wr
from ..sources import tables
from ..sources import text as Tx
from ..sources import vectors as Vs
from ..oracle import sqltext as S
from ..sources.vectors import SQL_BOUND_VECTORS
from .common import SQL_SCORED, scored_labelled

_SQL_VEC_DIMS = (f"SELECT token, CAST(len(vec) AS INTEGER) AS dim, round(list_sum(list_transform(vec, lambda x, i: "
                 f"CAST(x AS DOUBLE) * i)), 4) AS checksum FROM ({SQL_BOUND_VECTORS})")
_SQL_SENT = ("SELECT doc_id, CAST(generate_subscripts(sw, 1) - 1 AS INTEGER) AS sent_no, "
             "CAST(len(unnest(sw)) AS INTEGER) AS n, array_to_string(unnest(sw), ' ') AS words FROM (SELECT doc_id, list_transform("
             + S.sentence_split(S.ascii_only("text")) + ", lambda s: " + S.review_words("s") + ") AS sw FROM documents)")


def _vector_rows(v):
    """Per word the dimension and a checksum that sees every component and its place."""
    terms = F.transform("vec", lambda x, i: x.cast("double") * (i + 1))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return v.select("token", F.size("vec").alias("dim"), F.round(total, 4).alias("checksum"))


@query("src_lines",
       "SELECT text, count(*) AS n FROM (SELECT regexp_replace(unnest(string_split(text, chr(10))), '^\\s+|\\s+$', '', 'g') AS text "
       "FROM documents) GROUP BY text")
def q_src_lines(spark, sf):
    """Document texts written as a line file and read back stripped and numbered: how often each line stands
    (the numbers are checked to run from 1 without gaps; file order itself depends on the writer)."""
    path = shared_path(spark, "lines")
    tables.documents(spark, sf, "text").write.text(path)
    lines = materialize(Tx.read_lines(spark, path, numbered=True), "numbered-lines")
    gaps = lines.agg(F.count(F.lit(1)).alias("n"), F.min("line_no").alias("lo"), F.max("line_no").alias("hi"),
                     F.count_distinct("line_no").alias("d")).first()
    if gaps["n"] and (gaps["lo"], gaps["hi"], gaps["d"]) != (1, gaps["n"], gaps["n"]):
        raise ValueError("line numbers have gaps")
    return lines.groupBy("text").agg(F.count(F.lit(1)).alias("n"))


@query("src_tsv",
       "SELECT '\"' || d.doc_id || '\"' AS id, CAST(l.quality AS INTEGER) AS sentiment, "
       "regexp_replace(d.text, '[\\t\\r\\n]+', ' ', 'g') AS review FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def q_src_tsv(spark, sf):
    """Labelled reviews as a header TSV (quoting off), read back with an explicit schema."""
    path = shared_path(spark, "tsv")
    lab = tables.labelled_documents(spark, sf)
    review = F.regexp_replace("text", r"[\t\r\n]+", " ")
    (lab.select(F.concat(F.lit('"'), F.col("doc_id").cast("string"), F.lit('"')).alias("id"),
                F.col("label").alias("sentiment"), review.alias("review"))
        .write.option("sep", "\t").option("header", True).option("quote", "").option("escape", "")
        .csv(path))
    return Tx.read_tsv(spark, path)


@query("src_vectors_text", _SQL_VEC_DIMS)
def q_src_vectors_text(spark, sf):
    """Word vectors written as a text vector file, read back (last line wins)."""
    path = shared_path(spark, "vectext")
    Wr.write_vectors_text(Vs.bound_vectors(spark, sf), path, header=False)
    return _vector_rows(Vs.read_vector_text(spark, path))


@query("src_vectors_w2v", _SQL_VEC_DIMS)
def q_src_vectors_w2v(spark, sf):
    """The same with the ``n dim`` header line (format conversion + reader)."""
    path = shared_path(spark, "w2vtext")
    Wr.write_vectors_text(Vs.bound_vectors(spark, sf), path, header=True)
    return _vector_rows(Vs.read_vector_text(spark, path, header=True))


@query("sink_vectors", _SQL_VEC_DIMS)
def q_sink_vectors(spark, sf):
    path = shared_path(spark, "vectors")
    Wr.write_vectors(Vs.bound_vectors(spark, sf), path)
    return _vector_rows(Vs.read_vectors_parquet(spark, path))


@query("sink_report",
       f"SELECT doc_id, label, pred, 'all' AS sheet FROM ({SQL_SCORED}) UNION ALL "
       f"SELECT doc_id, label, pred, 'wrong' AS sheet FROM ({SQL_SCORED}) "
       f"WHERE (label < 0.5 AND pred > 0.5) OR (label > 0.5 AND pred < 0.5)")
def q_sink_report(spark, sf):
    """Prediction report (sheets ``all`` / ``wrong``), read back."""
    path = shared_path(spark, "report")
    Wr.write_report(scored_labelled(spark, sf).select("doc_id", "text", "label", "pred"), path)
    return spark.read.parquet(path).select("doc_id", "label", "pred", "sheet")


@query("sink_sentences", _SQL_SENT)
def q_sink_sentences(spark, sf):
    """Sentence corpus written as JSON lines, read back with its schema."""
    path = shared_path(spark, "sentences")
    sc = sentence_corpus(tables.documents(spark, sf))
    Wr.write_sentences(sc, path)
    back = spark.read.schema("doc_id long, sent_no int, words array<string>").json(path)
    return back.select("doc_id", "sent_no", F.size("words").alias("n"), F.array_join("words", " ").alias("words"))


@query("stream_clean",
       f"SELECT doc_id, text, CAST(len({S.word_tokens('text')}) AS INTEGER) AS n_tokens FROM "
       f"(SELECT doc_id, {S.clean_sentence('text')} AS text FROM documents)")
def q_stream_clean(spark, sf):
    """The documents table as a file stream: sentence normaliser + token count,
    processed with an available-now trigger into a Parquet sink, read back."""
    from ..streaming.rowlocal import clean_and_count, run_available_now, table_stream
    out = shared_path(spark, "stream-out")
    run_available_now(clean_and_count(table_stream(spark, sf)), out, shared_path(spark, "stream-ckpt"))
    return spark.read.parquet(out)


def _sql_stream_encode():
    from .common import sql_long
    from .vocab_queries import _SQL_VFREQ, _sql_encoded, _sql_seq_out
    docs = f"SELECT doc_id, {S.clean_sentence('text')} AS text FROM documents"
    return _sql_seq_out(_sql_encoded(sql_long(docs, S.freq_tokens("text")), _SQL_VFREQ, docs, "idx < 20000"))


@query("stream_encode", _sql_stream_encode())
def q_stream_encode(spark, sf):
    """Every document arriving as a stream, encoded with the frequency
    vocabulary fitted (batch) on the labelled texts and capped at 20000: a
    stream-static lookup per micro-batch via ``foreachBatch``."""
    from ..functions.clean import clean_sentence
    from ..functions.arrays import join_ints
    from ..operators.encode import encode_drop_oov
    from ..operators.tokens import explode_tokens
    from ..operators.vocab import capped, vocab_freq
    from ..session import materialize
    from ..streaming.rowlocal import run_batches_available_now, table_stream
    from .common import sentences_labelled
    fitted = sentences_labelled(spark, sf)
    vocab = materialize(capped(vocab_freq(explode_tokens(fitted, T.freq_tokens("text"))), 20000), "stream-vocab")

    def per_batch(batch):
        cleaned = batch.select("doc_id", clean_sentence("text").alias("text"))
        enc = encode_drop_oov(cleaned, T.freq_tokens("text"), vocab, cap=20000)
        return enc.select("doc_id", F.size("seq").cast("bigint").alias("n"), join_ints("seq").alias("seq"))

    out = shared_path(spark, "stream-encode")
    run_batches_available_now(table_stream(spark, sf), per_batch, out, shared_path(spark, "stream-encode-ckpt"))
    return spark.read.parquet(out).select("doc_id", "n", "seq")
