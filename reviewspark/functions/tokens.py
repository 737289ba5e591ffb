"""Tokenisers as Column -> array<string> expressions (higher-order functions,
no Python on the row path); ``normalised_words`` does one of them on whole Arrow arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import _col, kept_runs, strip_html
from .fixed import FREQ_FILTERS, STOP_WORDS

# ASCII whitespace as split on by a plain ``split()`` of byte strings
WS = r"[ \t\n\r\f\x0B]+"


def whitespace_split(c) -> Column:
    """``s.split()``: runs of whitespace separate tokens; no empty tokens."""
    return F.filter(F.split(F.coalesce(_col(c), F.lit("")), WS), lambda x: x != "")


def alpha_only(tokens) -> Column:
    return F.filter(_col(tokens), lambda x: x.rlike("^[A-Za-z]+$"))


def lower_all(tokens) -> Column:
    return F.transform(_col(tokens), lambda x: F.lower(x))


def drop_stop_words(tokens, stops=STOP_WORDS) -> Column:
    """Remove stop words and keep duplicates (``array_except`` would de-duplicate)."""
    return F.filter(_col(tokens), lambda x: ~x.isin(list(stops)))


def min_length(tokens, n: int = 2) -> Column:
    return F.filter(_col(tokens), lambda x: F.length(x) >= n)


def clean_tokens(c, stops=STOP_WORDS) -> Column:
    """Token filter chain in its original order: whitespace split, alphabetic
    tokens only (``good,`` and ``don't`` are dropped whole), lower-case, stop
    words out, one-letter tokens out.  One fused expression."""
    alpha = F.filter(whitespace_split(c), lambda x: x.rlike("^[A-Za-z]{2,}$"))
    low = F.transform(alpha, lambda x: F.lower(x))
    if stops:
        return F.filter(low, lambda x: ~x.isin(list(stops)))
    return low


def review_words(c, remove_stop_words: bool = False, stops=STOP_WORDS) -> Column:
    """Review to word list: HTML strip, keep rule, lower-case, split."""
    # what the keep rule and a split at white space leave
    words = F.transform(kept_runs(strip_html(c)), lambda w: F.lower(w))
    return drop_stop_words(words, stops) if remove_stop_words else words


def freq_tokens(c) -> Column:
    """Frequency tokeniser split: lower-case, filter characters become spaces,
    split on single spaces, drop empty strings."""
    src = F.lower(F.coalesce(_col(c), F.lit("")))
    return F.filter(F.split(F.translate(src, FREQ_FILTERS, " " * len(FREQ_FILTERS)), " "),
                    lambda x: x != "")


def word_tokens(c) -> Column:
    """Count-vectoriser tokens: lower-case, maximal runs of >= 2 word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(c), F.lit(""))),
                                F.lit("[a-z0-9_]{2,}"), 0)


# lower-case letters and digits by byte; 0 for whatever parts words
_WORD_BYTE = np.zeros(256, np.uint8)
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    _WORD_BYTE[_c] = _c
_WORD_BYTE[65:91] = _WORD_BYTE[97:123]


def normalised_words(texts):
    """``word_tokens(clean_sentence(text))`` of an Arrow string array: all words in order, and the place of each one's text.

    The same words as the two expressions give, found on the bytes of the whole array.  The first sentence rule leaves
    ASCII letters, digits and marks; of the others only that for ``n't`` cuts a word: its ``n`` stands alone, which is too
    short for a token.
    """
    import pyarrow as pa

    texts = texts.cast(pa.large_string()).fill_null("")
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offs[0]:offs[-1]]
    offs = offs - offs[0]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offs] = True
    low = _WORD_BYTE[raw]
    cut = np.flatnonzero((raw[:-2] == ord("n")) & (raw[1:-1] == ord("'")) & (raw[2:] == ord("t")))
    low[cut[~edge[cut + 1] & ~edge[cut + 2]]] = 0
    solid = low > 0
    gap = np.ones(len(raw) + 1, bool)  # no word goes on across place i
    gap[1:-1] = ~solid[1:] | ~solid[:-1] | edge[1:-1]
    starts, ends = np.flatnonzero(solid & gap[:-1]), np.flatnonzero(solid & gap[1:]) + 1
    long = ends - starts > 1
    low[starts[~long]] = 0
    starts, ends = starts[long], ends[long]
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(low[low > 0]))
    return words, np.searchsorted(offs, starts, "right") - 1


def word_count(c) -> Column:
    return F.size(whitespace_split(c))


def sentence_split(c) -> Column:
    """Rule-based sentence split: a sentence ends at a run of ``.``, ``!`` or ``?``.
    Sentences are trimmed and empty ones skipped."""
    parts = F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit(r"[^.!?]+[.!?]*"), 0)
    parts = F.transform(parts, lambda s: F.regexp_replace(s, r"^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$", ""))
    return F.filter(parts, lambda s: F.length(s) > 0)


def sentence_words(c, remove_stop_words: bool = False) -> Column:
    """Document to list of sentences, each a word list (review_words per sentence)."""
    return F.transform(sentence_split(c), lambda s: review_words(s, remove_stop_words))


def ngrams(tokens, n: int) -> Column:
    """All word n-grams of one order, joined by a space."""
    t = _col(tokens)
    return F.when(F.size(t) >= n,
                  F.transform(F.sequence(F.lit(1), F.size(t) - n + 1),
                              lambda i: F.array_join(F.slice(t, i, n), " "))
                  ).otherwise(F.array().cast("array<string>"))


def ngram_range(tokens, lo: int, hi: int) -> Column:
    """All word n-grams for n in [lo, hi], shortest first."""
    return F.flatten(F.array(*[ngrams(tokens, n) for n in range(lo, hi + 1)]))
