"""Sentence boundaries learned from the corpus (unsupervised, after Kiss and Strunk, 2006).

A full stop ends a sentence unless it belongs to an abbreviation.  Abbreviations are words that nearly always carry a
full stop, are short, and have full stops inside: the log-likelihood ratio of a word's stops against the corpus rate is
weighted by these.  After an abbreviation a sentence still ends if the next word starts with a capital and is a frequent
sentence starter, which a second log-likelihood ratio tells from the words that follow sure breaks.

Learning is two aggregates by word (map-side combined).  What is learned are two lists of words, whole whatever their
length.  Lists of at most ``MOST`` words each travel as literal tables, so that applying them is row-local and no text
moves; longer ones are joined to the words that may end a sentence, with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.literal import literal_map
from ..session import materialize
from .joins import lookup

ABBREVIATION, STARTER = 0.3, 30.0   # least scores
MOST = 20_000                       # words of a list that travels as a literal

# fixed values of the method: white space, what may close a sentence, what stands around a word
SPACE = r"[\x20\x09-\x0D]+"
CLOSES = r"[.!?]+[\"')\]]*$"
AROUND = r"^[^A-Za-z0-9]+|[^A-Za-z0-9.]+$"


def words_of(text) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACE), lambda w: w != "")


def core(word: Column) -> Column:
    """The word in lower case without what stands around it; a full stop at its end stays."""
    return F.lower(F.regexp_replace(word, AROUND, ""))


def base(word: Column) -> Column:
    return F.regexp_replace(core(word), r"\.+$", "")


def closes(word: Column) -> Column:
    """The word ends like a sentence; most words hold no mark, and need no search."""
    marked = F.contains(word, F.lit(".")) | F.contains(word, F.lit("!")) | F.contains(word, F.lit("?"))
    return F.when(marked, word.rlike(CLOSES)).otherwise(False)


def _is_word(b: Column) -> Column:
    return b.rlike("[a-z]")


def _xlogy(x: Column, y: Column) -> Column:
    return F.when(x == 0, 0.0).otherwise(x * F.log(y))


def abbreviations(pairs: DataFrame) -> DataFrame:
    """``(word, n_stop, n_plain, score)`` of the words with ``score >= ABBREVIATION``; ``pairs(word, nxt)``."""
    # words are counted as they stand, so that each spelling is taken apart once
    raw = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("c"))
    some = raw.select(base(F.col("word")).alias("b"), core(F.col("word")).endswith(".").alias("stop"), "c").where(_is_word(F.col("b")))
    per = materialize(some.groupBy("b").agg(F.sum(F.when(F.col("stop"), F.col("c")).otherwise(0)).alias("n_stop"),
                                            F.sum(F.when(F.col("stop"), 0).otherwise(F.col("c"))).alias("n_plain")), "word-stops")
    n = per.select(F.sum(F.col("n_stop") + F.col("n_plain"))).scalar().cast("double")
    rate = per.select(F.sum("n_stop")).scalar().cast("double") / n
    stop, plain = F.col("n_stop").cast("double"), F.col("n_plain").cast("double")
    ratio = -2.0 * (_xlogy(stop, rate) + _xlogy(plain, 1.0 - rate) - _xlogy(stop, F.lit(0.99)) - _xlogy(plain, F.lit(0.01)))
    inner = F.length("b") - F.length(F.replace(F.col("b"), F.lit("."), F.lit("")))
    letters = (F.length("b") - inner).cast("double")
    score = ratio * F.exp(-letters) * (inner + 1.0) * F.pow(letters, -plain)
    return per.where("n_stop > 0").select(F.col("b").alias("word"), "n_stop", "n_plain", score.alias("score")).where(F.col("score") >= ABBREVIATION)


def starters(pairs: DataFrame, is_abbreviation) -> DataFrame:
    """``(word, n, n_after, score)`` of the words that follow sure breaks far more often than others do."""
    pairs = pairs.where("nxt IS NOT NULL")
    if isinstance(is_abbreviation, DataFrame):
        # only words that close with a full stop are looked up, each different one once beside its next word
        stopped = F.when(closes(F.col("word")) & core(F.col("word")).endswith("."), base(F.col("word")))
        seen = pairs.groupBy("nxt", stopped.alias("_stopped"), F.coalesce(closes(F.col("word")), F.lit(False)).alias("_closes")).agg(F.count(F.lit(1)).alias("_c"))
        seen = _flagged(seen, is_abbreviation, "_stopped", "_held")
        raw = seen.groupBy("nxt").agg(F.sum("_c").alias("n"), F.sum(F.when(F.col("_closes") & ~F.col("_held"), F.col("_c")).otherwise(0)).alias("n_after"))
    else:
        sure = F.when(closes(F.col("word")), ~(core(F.col("word")).endswith(".") & is_abbreviation(base(F.col("word"))))).otherwise(False)
        raw = pairs.groupBy("nxt").agg(F.count(F.lit(1)).alias("n"), F.sum(sure.cast("long")).alias("n_after"))
    some = raw.select(base(F.col("nxt")).alias("b"), "n", "n_after").where(_is_word(F.col("b")))
    per = materialize(some.groupBy("b").agg(F.sum("n").alias("n"), F.sum("n_after").alias("n_after")), "word-starts")
    total = per.select(F.sum("n")).scalar().cast("double")
    breaks = per.select(F.sum("n_after")).scalar().cast("double")
    a, ab = F.col("n").cast("double"), F.col("n_after").cast("double")
    p, p1, p2 = breaks / total, ab / a, (breaks - ab) / (total - a)
    rest = total - a - breaks + ab
    null = _xlogy(ab, p) + _xlogy(a - ab, 1.0 - p) + _xlogy(breaks - ab, p) + _xlogy(rest, 1.0 - p)
    own = _xlogy(ab, p1) + _xlogy(a - ab, 1.0 - p1) + _xlogy(breaks - ab, p2) + _xlogy(rest, 1.0 - p2)
    score = -2.0 * (null - own)
    return (per.where((p1 > p) & (total > a)).select(F.col("b").alias("word"), "n", "n_after", score.alias("score"))
            .where(F.col("score") >= STARTER))


def _listed(found: DataFrame, most: int):
    """The words of ``found``: a function from a word to a boolean if there are at most ``most``, else a written table."""
    found = materialize(found.select("word", "score", F.xxhash64("word").alias("h")), "word-list")
    rows = found.limit(most + 1).collect()
    if len(rows) > most:
        return found.select("word")
    known = literal_map([(r["word"], r["score"], r["h"]) for r in rows])
    return lambda b: known(b).isNotNull()


def _flagged(rows: DataFrame, listed, on: str, name: str) -> DataFrame:
    """``rows`` with the column ``name``: whether the word in ``on`` is listed."""
    if not isinstance(listed, DataFrame):
        return rows.withColumn(name, F.coalesce(listed(F.col(on)), F.lit(False)))
    known = listed.select(F.col("word").alias(on), F.lit(True).alias(name))
    return lookup(rows, known, on, "left", check=True).withColumn(name, F.coalesce(name, F.lit(False)))


def word_pairs(df: DataFrame, text: str = "text") -> DataFrame:
    """``(word, nxt)``: every word with the one that follows it in its text."""
    w = df.select(words_of(text).alias("_w"))
    return w.select(F.explode(F.transform("_w", lambda x, i: F.struct(x.alias("word"), F.get("_w", i + 1).alias("nxt")))).alias("p")).select("p.*")


def learn(df: DataFrame, text: str = "text", most: int = MOST):
    """``(abbreviations, starters)``: functions from a word's base to a boolean, or tables ``(word)`` of more than ``most``
    words."""
    pairs = word_pairs(df, text)
    is_abbreviation = _listed(abbreviations(pairs), most)
    return is_abbreviation, _listed(starters(pairs, is_abbreviation), most)


def trained_sentences(df: DataFrame, text: str = "text", key: str = "doc_id", learned=None) -> DataFrame:
    """``(key, sent_no, sentence)``: words joined by single spaces, one row a sentence, numbered from 0.

    Null and empty texts have none.  ``learned`` (of ``learn``) may come from another corpus.
    """
    is_abbreviation, is_starter = learned or learn(df, text)

    def ends(w: Column, nxt: Column, known, starts) -> Column:
        b = base(w)
        stop = core(w).endswith(".")
        held = known | (F.length(b) == 1) & _is_word(b)                         # abbreviations and initials
        opens = nxt.rlike(r"^[^A-Za-z0-9]*[A-Z]") & starts
        number = b.rlike(r"^[0-9]+$") & nxt.rlike("^[a-z]")                     # "3. floor"
        return nxt.isNull() | w.rlike(CLOSES) & F.when(stop, F.when(held, opens).otherwise(~number)).otherwise(True)

    rows = df.select(key, words_of(text).alias("_w"))
    # the words whose place matters are told first, so that each is tested once
    may = F.filter(F.transform("_w", lambda x, i: F.when(closes(x) | (i == F.size("_w") - 1), i)), lambda i: i.isNotNull())
    if isinstance(is_abbreviation, DataFrame) or isinstance(is_starter, DataFrame):
        rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "word-rows")
        asked = rows.select("_row", "_w", F.explode(may).alias("_i")).select("_row", "_i", F.get("_w", F.col("_i")).alias("_x"), F.get("_w", F.col("_i") + 1).alias("_nxt"))
        asked = asked.select("*", base(F.col("_x")).alias("_b"), base(F.col("_nxt")).alias("_nb"))
        asked = _flagged(_flagged(asked, is_abbreviation, "_b", "_known"), is_starter, "_nb", "_starts")
        asked = asked.where(ends(F.col("_x"), F.col("_nxt"), F.col("_known"), F.col("_starts")))
        found = asked.groupBy(F.col("_row").alias("_of")).agg(F.sort_array(F.collect_list("_i")).alias("_end"))
        rows = rows.join(found, F.col("_row") == F.col("_of")).select(key, "_w", "_end")
    else:
        def at(i: Column) -> Column:
            w, nxt = F.get("_w", i), F.get("_w", i + 1)
            return ends(w, nxt, is_abbreviation(base(w)), is_starter(base(nxt)))

        rows = rows.select(key, "_w", may.alias("_may"))
        rows = rows.select(key, "_w", F.filter("_may", at).alias("_end"))
    cut = F.transform("_end", lambda e, j: F.array_join(F.slice(
        "_w", F.when(j == 0, 1).otherwise(F.get("_end", j - 1) + 2), e - F.when(j == 0, -1).otherwise(F.get("_end", j - 1))), " "))
    return rows.select(key, F.posexplode(cut).alias("sent_no", "sentence"))
