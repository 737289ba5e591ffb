"""Sources, cleaning and tokenising queries.

Token lists are reported as ``(key, n, tokens)`` with the list joined by
single spaces, so both engines compare scalar columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..functions import clean as C
from ..functions import tokens as T
from ..functions.fixed import STOP_WORDS
from ..operators import sentences as Sn
from ..operators.tokens import explode_tokens, ngram_table, sentence_corpus
from ..oracle import sqltext as S
from ..sources import tables
from ..sources.text import label_code
from .common import LABELLED, SQL_REVIEWS, SQL_SENTENCES, reviews_labelled, sentences_labelled


def _listed(df, key, arr):
    return df.select(key, F.size(arr).cast("bigint").alias("n"), F.array_join(arr, " ").alias("tokens"))


def _sql_listed(src, key, expr):
    return f"SELECT {key}, CAST(len(tk) AS BIGINT) AS n, array_to_string(tk, ' ') AS tokens FROM (SELECT {key}, {expr} AS tk FROM ({src}))"


_DOCS = "SELECT doc_id, text FROM documents"
_PAGES = "SELECT page_id, html FROM pages"


@query("src_pos_neg",
       f"SELECT d.doc_id, {S.clean_sentence('d.text')} AS text, CASE WHEN l.quality = 1 THEN 1 ELSE 0 END AS label "
       f"FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IN (0, 1)")
def q_src_pos_neg(spark, sf):
    """Labelled pair source: a positive and a negative table, united and cleaned, with the code of the class name."""
    lab = tables.labelled_documents(spark, sf).withColumnRenamed("label", "quality")
    pos = lab.where("quality = 1").select("doc_id", "text", F.lit("pos").alias("class"))
    neg = lab.where("quality = 0").select("doc_id", "text", F.lit("neg").alias("class"))
    both = pos.unionByName(neg)
    return both.select("doc_id", C.clean_sentence("text").alias("text"), label_code("class").alias("label"))


@query("clean_sentence", f"SELECT doc_id, {S.clean_sentence('text')} AS text FROM documents")
def q_clean_sentence(spark, sf):
    return tables.documents(spark, sf).select("doc_id", C.clean_sentence("text").alias("text"))


@query("strip_html", f"SELECT page_id, {S.strip_html('html')} AS text FROM pages")
def q_strip_html(spark, sf):
    return tables.pages(spark, sf).select("page_id", C.strip_html("html").alias("text"))


@query("clean_review", f"SELECT page_id, {S.keep_rule(S.strip_html('html'))} AS text FROM pages")
def q_clean_review(spark, sf):
    return tables.pages(spark, sf).select("page_id", C.clean_review("html").alias("text"))


@query("review_words", _sql_listed(_PAGES, "page_id", S.review_words("html")))
def q_review_words(spark, sf):
    return _listed(tables.pages(spark, sf), "page_id", T.review_words("html"))


@query("review_words_nostop", _sql_listed(_PAGES, "page_id", S.review_words("html", True)))
def q_review_words_nostop(spark, sf):
    return _listed(tables.pages(spark, sf), "page_id", T.review_words("html", remove_stop_words=True))


@query("ascii_only", f"SELECT doc_id, {S.ascii_only('text')} AS text FROM documents")
def q_ascii_only(spark, sf):
    return tables.documents(spark, sf).select("doc_id", C.ascii_only("text").alias("text"))


@query("clean_tokens", _sql_listed(SQL_REVIEWS, "doc_id", S.clean_tokens("text")))
def q_clean_tokens(spark, sf):
    return _listed(reviews_labelled(spark, sf), "doc_id", T.clean_tokens("text"))


@query("tok_split", _sql_listed(SQL_REVIEWS, "doc_id", S.ws_split("text")))
def q_tok_split(spark, sf):
    return _listed(reviews_labelled(spark, sf), "doc_id", T.whitespace_split("text"))


@query("tok_alpha", _sql_listed(SQL_REVIEWS, "doc_id",
                                f"list_transform(list_filter({S.ws_split('text')}, lambda x: regexp_full_match(x, '[A-Za-z]+')), lambda x: lower(x))"))
def q_tok_alpha(spark, sf):
    return _listed(reviews_labelled(spark, sf), "doc_id", T.lower_all(T.alpha_only(T.whitespace_split("text"))))


@query("tok_stopwords", _sql_listed(SQL_REVIEWS, "doc_id",
                                    f"list_filter(list_transform({S.ws_split('text')}, lambda x: lower(x)), "
                                    f"lambda x: NOT list_contains({S.stop_list()}, x))"))
def q_tok_stopwords(spark, sf):
    return _listed(reviews_labelled(spark, sf), "doc_id",
                   T.drop_stop_words(T.lower_all(T.whitespace_split("text"))))


@query("tok_minlen", _sql_listed(SQL_REVIEWS, "doc_id", f"list_filter({S.ws_split('text')}, lambda x: length(x) > 1)"))
def q_tok_minlen(spark, sf):
    return _listed(reviews_labelled(spark, sf), "doc_id", T.min_length(T.whitespace_split("text"), 2))


@query("tok_freq", _sql_listed(SQL_SENTENCES, "doc_id", S.freq_tokens("text")))
def q_tok_freq(spark, sf):
    return _listed(sentences_labelled(spark, sf), "doc_id", T.freq_tokens("text"))


@query("tok_words", _sql_listed(SQL_SENTENCES, "doc_id", S.word_tokens("text")))
def q_tok_words(spark, sf):
    return _listed(sentences_labelled(spark, sf), "doc_id", T.word_tokens("text"))


@query("word_count", f"SELECT doc_id, CAST(len({S.ws_split('text')}) AS BIGINT) AS n_words FROM documents")
def q_word_count(spark, sf):
    return tables.documents(spark, sf).select("doc_id", T.word_count("text").cast("bigint").alias("n_words"))


@query("filter_min_words",
       f"SELECT doc_id, text, label FROM ({SQL_SENTENCES}) WHERE len({S.ws_split('text')}) > 10")
def q_filter_min_words(spark, sf):
    return sentences_labelled(spark, sf).where(T.word_count("text") > 10)


@query("sentences",
       f"SELECT doc_id, generate_subscripts(ss, 1) - 1 AS sent_no, unnest(ss) AS sentence "
       f"FROM (SELECT doc_id, {S.sentence_split(S.ascii_only('text'))} AS ss FROM documents)")
def q_sentences(spark, sf):
    docs = tables.documents(spark, sf)
    return docs.select("doc_id", F.posexplode(T.sentence_split(C.ascii_only("text"))).alias("sent_no", "sentence")) \
               .withColumn("sent_no", F.col("sent_no").cast("bigint"))


def _sql_sentence_words(src, key="doc_id", extra=""):
    words = "list_transform(ss, lambda s: " + S.review_words("s") + ")"
    return (f"SELECT {key}{extra}, generate_subscripts(sw, 1) - 1 AS sent_no, unnest(sw) AS w "
            f"FROM (SELECT {key}{extra}, {words} AS sw FROM "
            f"(SELECT {key}{extra}, {S.sentence_split(S.ascii_only('text'))} AS ss FROM ({src})))")


@query("sentence_corpus",
       f"SELECT doc_id, sent_no, CAST(len(w) AS BIGINT) AS n, array_to_string(w, ' ') AS words "
       f"FROM ({_sql_sentence_words(_DOCS)})")
def q_sentence_corpus(spark, sf):
    sc = sentence_corpus(tables.documents(spark, sf))
    return sc.select("doc_id", F.col("sent_no").cast("bigint").alias("sent_no"),
                     F.size("words").cast("bigint").alias("n"), F.array_join("words", " ").alias("words"))


@query("corpus_union",
       f"SELECT doc_id, sent_no, label, array_to_string(w, ' ') AS words FROM ({_sql_sentence_words(LABELLED, extra=', label')}) "
       f"UNION ALL SELECT doc_id, sent_no, -1 AS label, array_to_string(w, ' ') AS words FROM "
       f"({_sql_sentence_words('SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)')})")
def q_corpus_union(spark, sf):
    """Labelled and unlabelled sentence corpora in one table (``label`` -1 = unlabelled)."""
    # both halves come from one left join with the labels: the texts are read once
    labels = tables.table(spark, sf, "labels", "doc_id", "quality").withColumn("has", F.lit(True))
    every = tables.documents(spark, sf).join(labels, "doc_id", "left")
    label = F.when(F.col("has"), F.col("quality")).otherwise(-1).cast("int")
    corpus = sentence_corpus(every.select("doc_id", "text", label.alias("label")), keep=("label",))
    return corpus.select("doc_id", F.col("sent_no").cast("bigint").alias("sent_no"), "label",
                         F.array_join("words", " ").alias("words"))


_GRAMS_SQL = []
for _n in range(1, 6):
    _GRAMS_SQL.append(
        f"SELECT doc_id, array_to_string(list_slice(tk, i, i + {_n - 1}), ' ') AS gram "
        f"FROM (SELECT doc_id, tk, unnest(range(1, len(tk) - {_n - 1} + 1)) AS i FROM "
        f"(SELECT doc_id, {S.word_tokens('text')} AS tk FROM ({SQL_SENTENCES})))")


@query("ngrams", "SELECT gram, count(*) AS n FROM (" + " UNION ALL ".join(_GRAMS_SQL) + ") GROUP BY gram")
def q_ngrams(spark, sf):
    """Counts of all word 1..5-grams of the labelled documents."""
    grams = ngram_table(sentences_labelled(spark, sf), T.word_tokens("text"), 1, 5)
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


@query("tokens_no_stop",
       f"SELECT t.doc_id, t.pos, t.token FROM (SELECT doc_id, unnest(tk) AS token, generate_subscripts(tk, 1) - 1 AS pos "
       f"FROM (SELECT doc_id, {S.review_words('text')} AS tk FROM ({LABELLED}))) t "
       f"WHERE t.token NOT IN (SELECT unnest({S.stop_list()}))")
def q_tokens_no_stop(spark, sf):
    """Stop words removed by a broadcast anti-join against the (fixed, 179-row) stop table."""
    lab = tables.labelled_documents(spark, sf)
    long = explode_tokens(lab, T.review_words("text"))
    stops = spark.createDataFrame([(w,) for w in STOP_WORDS], "token string")
    return long.join(F.broadcast(stops), "token", "left_anti").select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token")


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_XLOGY = lambda x, y: f"(CASE WHEN {x} = 0 THEN 0.0 ELSE {x} * ln({y}) END)"
_SQL_WORD_STOPS = (
    f"w AS (SELECT doc_id, unnest(tk) AS word, generate_subscripts(tk, 1) AS i FROM (SELECT doc_id, "
    f"list_filter(regexp_split_to_array(coalesce(text, ''), {_q(Sn.SPACE)}), lambda x: x <> '') AS tk FROM documents)), "
    f"t0 AS (SELECT doc_id, i, word, lead(word) OVER (PARTITION BY doc_id ORDER BY i) AS nxt, "
    f"lower(regexp_replace(word, {_q(Sn.AROUND)}, '', 'g')) AS c FROM w), "
    r"t AS (SELECT *, regexp_replace(c, '\.+$', '') AS b, regexp_replace(lower(regexp_replace(nxt, " + _q(Sn.AROUND) + r", '', 'g')), '\.+$', '') AS nb, "
    "c LIKE '%.' AS stop FROM t0), "
    "p AS (SELECT b, CAST(sum(CAST(stop AS INT)) AS DOUBLE) AS s, CAST(sum(CAST(NOT stop AS INT)) AS DOUBLE) AS pl FROM t "
    "WHERE regexp_matches(b, '[a-z]') GROUP BY b), "
    "r AS (SELECT sum(s) / sum(s + pl) AS rate FROM p), "
    f"a0 AS (SELECT b, s, pl, length(b) - length(replace(b, '.', '')) AS inr, -2.0 * ({_XLOGY('s', 'rate')} + {_XLOGY('pl', '(1.0 - rate)')} "
    f"- {_XLOGY('s', 'CAST(0.99 AS DOUBLE)')} - {_XLOGY('pl', 'CAST(0.01 AS DOUBLE)')}) AS ratio FROM p, r), "
    f"ab AS (SELECT * FROM (SELECT *, ratio * exp(-CAST(length(b) - inr AS DOUBLE)) * (inr + 1.0) * pow(CAST(length(b) - inr AS DOUBLE), -pl) AS score "
    f"FROM a0 WHERE s > 0) WHERE score >= {Sn.ABBREVIATION})")
_SQL_TRAINED = (
    f"WITH {_SQL_WORD_STOPS}, "
    f"u AS (SELECT t.*, ab.b IS NOT NULL AS is_ab, regexp_matches(word, {_q(Sn.CLOSES)}) AS closes FROM t LEFT JOIN ab ON t.b = ab.b), "
    "q AS (SELECT nb AS b, CAST(count(*) AS DOUBLE) AS a, CAST(sum(CAST(closes AND NOT (stop AND is_ab) AS INT)) AS DOUBLE) AS k FROM u "
    "WHERE nxt IS NOT NULL AND regexp_matches(nb, '[a-z]') GROUP BY nb), "
    "z AS (SELECT sum(a) AS n, sum(k) AS br FROM q), "
    "st AS (SELECT q.b FROM q, z WHERE a < n AND k / a > br / n AND -2.0 * ("
    + " + ".join([_XLOGY("k", "(br / n)"), _XLOGY("(a - k)", "(1.0 - br / n)"), _XLOGY("(br - k)", "(br / n)"), _XLOGY("(n - a - br + k)", "(1.0 - br / n)")])
    + " - (" + " + ".join([_XLOGY("k", "(k / a)"), _XLOGY("(a - k)", "(1.0 - k / a)"), _XLOGY("(br - k)", "((br - k) / (n - a))"),
                           _XLOGY("(n - a - br + k)", "(1.0 - (br - k) / (n - a))")])
    + f")) >= {Sn.STARTER}), "
    "e AS (SELECT doc_id, i, word, nxt IS NULL OR (closes AND CASE WHEN stop THEN CASE WHEN is_ab OR (length(u.b) = 1 AND regexp_matches(u.b, '[a-z]')) "
    "THEN regexp_matches(nxt, '^[^A-Za-z0-9]*[A-Z]') AND st.b IS NOT NULL ELSE NOT (regexp_matches(u.b, '^[0-9]+$') AND regexp_matches(nxt, '^[a-z]')) END "
    "ELSE true END) AS fin FROM u LEFT JOIN st ON u.nb = st.b), "
    "g AS (SELECT *, coalesce(sum(CAST(fin AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no FROM e) "
    "SELECT doc_id, CAST(no AS BIGINT) AS sent_no, string_agg(word, ' ' ORDER BY i) AS sentence FROM g GROUP BY doc_id, no")


@query("abbreviations", f"WITH {_SQL_WORD_STOPS} SELECT b AS word, CAST(s AS BIGINT) AS n_stop, CAST(pl AS BIGINT) AS n_plain, "
       "round(score, 4) AS score FROM ab")
def q_abbreviations(spark, sf):
    """The abbreviations that the corpus teaches: words that nearly always carry a full stop."""
    found = Sn.abbreviations(Sn.word_pairs(tables.documents(spark, sf)))
    return found.select("word", "n_stop", "n_plain", F.round("score", 4).alias("score"))


@query("sentences_trained", _SQL_TRAINED)
def q_sentences_trained(spark, sf):
    """Sentences cut at boundaries learned from the corpus: no cut after abbreviations but before sentence starters."""
    out = Sn.trained_sentences(tables.documents(spark, sf).select("doc_id", "text"))
    return out.withColumn("sent_no", F.col("sent_no").cast("bigint"))
