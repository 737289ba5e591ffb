"""Text cleaning as Column -> Column expressions.

All of these are built-in ``regexp_replace`` / ``replace`` / ``lower`` chains:
they stay inside whole-stage codegen and never leave the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import HTML_ENTITIES, KEEP_PATTERN, SENTENCE_RULES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# the rules between the first and the last surround a fixed text with another: plain replacements, one by one
_LITERAL_RULES = [(re.sub(r"\\(.)", r"\1", pat), rep) for pat, rep in SENTENCE_RULES[1:-1]]


def kept_runs(c) -> Column:
    """The maximal runs of characters that the keep rule keeps (finding them costs a third of replacing what lies between)."""
    return F.regexp_extract_all(_col(c), F.lit("[" + KEEP_PATTERN[2:] + "+"), 0)


def clean_sentence(c) -> Column:
    """Sentence normaliser: the ordered rules, then strip and lower-case.

    Null text becomes the empty string so that a document never disappears.  The first rule takes whole runs, as the last
    one would make one space of them anyway; the rules between put at most one space on either side of a mark, so that
    runs of three spaces at most are left to the last rule, which halves them twice.
    """
    out = F.array_join(kept_runs(F.coalesce(_col(c), F.lit(""))), " ")
    for text, rep in _LITERAL_RULES:
        out = F.replace(out, F.lit(text), F.lit(rep))
    for _ in range(2):
        out = F.replace(out, F.lit("  "), F.lit(" "))
    # after the first rule only spaces are left as whitespace, so trim == strip
    return F.lower(F.trim(out))


def keep_rule(c) -> Column:
    """Replace every character outside ``[A-Za-z0-9(),!?'`]`` with a space (a space stays one: it need not match)."""
    return F.regexp_replace(_col(c), KEEP_PATTERN[:-1] + " ]", " ")


def strip_html(c, keep_script: bool = False) -> Column:
    """HTML to text: drop script/style bodies, comments and tags, then decode entities.

    Tags are removed with no separator, so ``a<br>b`` becomes ``ab``.  Script
    bodies go first because they may contain tag-like strings.
    """
    text = F.coalesce(_col(c), F.lit(""))
    out = text
    if not keep_script:
        out = F.regexp_replace(out, r"(?is)<script\b[^>]*>.*?</script\s*>", "")
        out = F.regexp_replace(out, r"(?is)<style\b[^>]*>.*?</style\s*>", "")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", "")
    out = F.when(F.contains(text, F.lit("<")), out).otherwise(text)  # no tag, no search
    for ent, txt in HTML_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(txt))
    return out


def clean_review(c) -> Column:
    """Review cleaner: HTML to text, then the keep rule (backslash and quote are
    already gone after it, so the two further deletions are no-ops)."""
    return keep_rule(strip_html(c))


def ascii_only(c) -> Column:
    """ASCII fold by deletion of every non-ASCII character."""
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"[^\x00-\x7F]", "")


def strip_line(c) -> Column:
    """Strip leading/trailing ASCII whitespace, as ``str.strip`` on byte strings
    (Spark's ``trim`` only strips spaces)."""
    return F.regexp_replace(_col(c), r"^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$", "")
