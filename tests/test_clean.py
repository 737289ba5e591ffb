"""Literal rows for branches the test tables never reach, and a plain-Python
cross-check of the sentence normaliser."""

import re

from pyspark.sql import functions as F

from reviewspark.functions import clean as C
from reviewspark.functions import tokens as T
from reviewspark.functions.fixed import SENTENCE_RULES

CASES = [
    ("He's don't (very) we've?! I'd they'll, you're  x",
     "he 's do n't \\( very \\) we 've \\? ! i 'd they 'll , you 're x"),
    ("a\\b \"q\" `tick` it'S", "a b q `tick` it's"),
    ("café naïve ’s 'tis 'dog", "caf na ve s 'tis 'dog"),
    ("(((??", "\\( \\( \\( \\? \\?"),
    ("", ""),
    ("   ", ""),
    ("tab\there\nnl", "tab here nl"),
    ("'s's n'tn't", "'s 's n't n't"),
]


def plain_clean(s: str) -> str:
    """Sequential application of every rule, then strip and lower."""
    for pat, rep in SENTENCE_RULES:
        s = re.sub(pat, lambda m, r=rep: r, s)
    return s.strip().lower()


def test_plain_reference_on_literals():
    for src, want in CASES:
        assert plain_clean(src) == want, src


def test_sentence_normaliser_literals(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CASES)], "i int, s string")
    got = {r.i: r.c for r in df.select("i", C.clean_sentence("s").alias("c")).collect()}
    for i, (_, want) in enumerate(CASES):
        assert got[i] == want, CASES[i][0]


def test_sentence_normaliser_matches_plain_python_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = docs.select("doc_id", "text", C.clean_sentence("text").alias("c")).collect()
    bad = [r.doc_id for r in rows if plain_clean(r.text or "") != r.c]
    assert not bad


def test_null_text_is_empty(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(C.clean_sentence("s")).first()[0] == ""


def test_token_filter_literal(spark):
    df = spark.createDataFrame([("Good, don't a The movie",)], "s string")
    assert df.select(T.clean_tokens("s", ["the"])).first()[0] == ["movie"]


def test_stop_words_keep_duplicates(spark):
    df = spark.createDataFrame([(["a", "the", "a"],)], "a array<string>")
    assert df.select(T.drop_stop_words("a", ["the"])).first()[0] == ["a", "a"]


def test_html_script_before_tags(spark):
    html = '<html><script>var t="</p>";x()</script><style>p{}</style><p>A&amp;B &lt;c&gt;</p><!-- hi --><br>d</html>'
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(C.strip_html("h")).first()[0] == "A&B <c>d"


def test_freq_tokens_keep_apostrophe(spark):
    df = spark.createDataFrame([("Don't STOP, me-now!\tok",)], "s string")
    assert df.select(T.freq_tokens("s")).first()[0] == ["don't", "stop", "me", "now", "ok"]


def test_word_tokens_two_chars(spark):
    df = spark.createDataFrame([("do n't a bc 12",)], "s string")
    assert df.select(T.word_tokens("s")).first()[0] == ["do", "bc", "12"]


def test_sentence_split(spark):
    df = spark.createDataFrame([("Hi there. Yes!! no  ",)], "s string")
    assert df.select(T.sentence_split("s")).first()[0] == ["Hi there.", "Yes!!", "no"]


def test_ngrams_short_input(spark):
    df = spark.createDataFrame([(["a", "b"],)], "t array<string>")
    assert df.select(T.ngram_range("t", 1, 3)).first()[0] == ["a", "b", "a b"]


def test_strip_line(spark):
    df = spark.createDataFrame([("\t  x y \r\n",)], "s string")
    assert df.select(C.strip_line("s")).first()[0] == "x y"


def _plain_review_clean(s: str) -> str:
    s = re.sub(r"(?is)<script\b[^>]*>.*?</script\s*>", "", s)
    s = re.sub(r"(?is)<style\b[^>]*>.*?</style\s*>", "", s)
    s = re.sub(r"(?s)<!--.*?-->", "", s)
    s = re.sub(r"(?s)<[^>]*>", "", s)
    for ent, txt in __import__("reviewspark.functions.fixed", fromlist=["x"]).HTML_ENTITIES:
        s = s.replace(ent, txt)
    return re.sub(r"[^A-Za-z0-9(),!?'`]", " ", s)


def _plain_token_chain(s: str, stops) -> list:
    words = s.split()
    words = [w for w in words if w.isascii() and w.isalpha()]
    words = [w.lower() for w in words]
    words = [w for w in words if w not in stops]
    return [w for w in words if len(w) > 1]


def test_token_chain_matches_plain_python_on_documents(spark):
    from reviewspark.functions.fixed import STOP_WORDS
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(50)
    rows = docs.select("doc_id", "text", T.clean_tokens(C.clean_review("text")).alias("t")).collect()
    stops = set(STOP_WORDS)
    for r in rows:
        assert r.t == _plain_token_chain(_plain_review_clean(r.text or ""), stops), r.doc_id


def test_pages_review_clean_matches_plain_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html")
    for r in pages.select("html", C.clean_review("html").alias("c")).collect():
        assert r.c == _plain_review_clean(r.html)


def test_cleaning_searches_no_gaps(spark):
    """Runs of kept characters are found, not the gaps replaced (three times the work); marks are plain replacements."""
    df = spark.createDataFrame([("a,,b  (c)?!'s  don't K\u212a\u00e9x\t\n.. ",), ("",), (None,)], "s string")
    plan = df.select(C.clean_sentence("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan
    assert [r[0] for r in df.select(C.clean_sentence("s")).collect()] == ["a , , b \\( c \\) \\? ! 's do n't k x", "", ""]
    from reviewspark.functions import tokens as T
    assert df.select(T.review_words("s")).first()[0] == ["a,,b", "(c)?!'s", "don't", "k", "x"]
