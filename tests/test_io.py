"""Sources and sinks: literal rows from the fixtures and round trips."""

import tempfile

from pyspark.sql import functions as F

from reviewspark.sinks import writers as Wr
from reviewspark.sources import text as Tx
from reviewspark.sources import vectors as Vs
from reviewspark.streaming.rowlocal import clean_and_count, document_stream, run_available_now


def _tmp():
    return tempfile.mkdtemp(prefix="rs-test-")


def test_vector_file_last_line_wins(spark):
    d = _tmp()
    with open(f"{d}/v.txt", "w") as f:
        f.write("the 0.1 0.2 0.3\ncat 1 2 3\nthe 9 8 7\n")
    got = {r.token: [round(x, 4) for x in r.vec] for r in Vs.read_vector_text(spark, d).collect()}
    assert got == {"the": [9.0, 8.0, 7.0], "cat": [1.0, 2.0, 3.0]}


def test_vector_file_with_header(spark):
    d = _tmp()
    with open(f"{d}/v.txt", "w") as f:
        f.write("2 3\nthe 0.1 0.2 0.3\ncat 1 2 3\n")
    got = {r.token for r in Vs.read_vector_text(spark, d, header=True).collect()}
    assert got == {"the", "cat"}


def test_tsv_quoting_off(spark):
    d = _tmp()
    with open(f"{d}/r.tsv", "w") as f:
        f.write('id\tsentiment\treview\n"1_8"\t1\tHe said "hi" there\n')
    r = Tx.read_tsv(spark, d).first()
    assert r.id == '"1_8"' and r.sentiment == 1 and r.review == 'He said "hi" there'


def test_line_file_strip_and_order(spark):
    d = _tmp()
    with open(f"{d}/pos.txt", "w") as f:
        f.write("  Good film!\t\nIt's great\n")
    with open(f"{d}/neg.txt", "w") as f:
        f.write("Bad (really)\n")
    rows = sorted(Tx.read_pos_neg_files(spark, f"{d}/pos.txt", f"{d}/neg.txt").collect())
    assert [(r.doc_id, r.text, r.label) for r in rows] == [
        (1, "good film !", 1), (2, "it 's great", 1), (3, "bad \\( really \\)", 0)]


def test_vectors_text_roundtrip(spark):
    d = _tmp() + "/out"
    vecs = spark.createDataFrame([("a", [1.5, -2.0]), ("b", [0.25, 3.0])], "token string, vec array<float>")
    Wr.write_vectors_text(vecs, d, header=True)
    back = {r.token: list(r.vec) for r in Vs.read_vector_text(spark, d, header=True).collect()}
    assert back == {"a": [1.5, -2.0], "b": [0.25, 3.0]}


def test_report_sheets(spark):
    d = _tmp() + "/rep"
    preds = spark.createDataFrame([(1, 1, 0.9), (2, 1, 0.2), (3, 0, 0.5)], "doc_id int, label int, pred double")
    Wr.write_report(preds, d)
    back = spark.read.parquet(d)
    assert back.where("sheet = 'all'").count() == 3
    assert [r.doc_id for r in back.where("sheet = 'wrong'").collect()] == [2]


def test_stream_equals_batch(spark):
    from reviewspark.functions.clean import clean_sentence
    sf = "/root/testdata/sf0.001"
    out, ck = _tmp() + "/o", _tmp() + "/c"
    run_available_now(clean_and_count(document_stream(spark, sf, glob="documents.parquet")), out, ck)
    streamed = spark.read.parquet(out).select("doc_id", "text")
    batch = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", clean_sentence("text").alias("text"))
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def test_stream_queries_read_a_table_that_is_a_folder(spark, tmp_path):
    from reviewspark.plans import sink_queries as Q
    rows = [(i, f"Text number {i}, a b{i % 3}.", "en", "web", 20) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    (tmp_path / "other_documents.parquet").mkdir()
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert {r.doc_id for r in Q.q_stream_clean(spark, str(tmp_path)).collect()} == set(range(40))
    assert {r.doc_id for r in Q.q_stream_encode(spark, f"{tmp_path}/").collect()} == set(range(40))
