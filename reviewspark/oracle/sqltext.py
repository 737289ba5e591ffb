"""SQL fragments (DuckDB dialect) for the oracle queries.

Written independently of the Spark expressions: the sentence rules are
applied one by one here (the Spark side merges adjacent rules), HTML and
token rules are spelled out with DuckDB list functions.
"""

from __future__ import annotations

from ..functions.fixed import (FREQ_FILTERS, HTML_ENTITIES, KEEP_PATTERN, SENTENCE_RULES,
                               STOP_WORDS)

WS = r"[ \t\n\r\f\x0B]+"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def re_repl(text: str) -> str:
    """Produced text -> RE2 rewrite string (only the backslash is special)."""
    return lit(text.replace("\\", "\\\\"))


def clean_sentence(e: str) -> str:
    out = f"coalesce({e}, '')"
    for pat, rep in SENTENCE_RULES:
        out = f"regexp_replace({out}, {lit(pat)}, {re_repl(rep)}, 'g')"
    return f"lower(trim({out}))"


def keep_rule(e: str) -> str:
    return f"regexp_replace({e}, {lit(KEEP_PATTERN)}, ' ', 'g')"


def strip_html(e: str) -> str:
    out = f"coalesce({e}, '')"
    for pat in (r"(?is)<script\b[^>]*>.*?</script\s*>", r"(?is)<style\b[^>]*>.*?</style\s*>",
                r"(?s)<!--.*?-->", r"(?s)<[^>]*>"):
        out = f"regexp_replace({out}, {lit(pat)}, '', 'g')"
    for ent, txt in HTML_ENTITIES:
        out = f"replace({out}, {lit(ent)}, {lit(txt)})"
    return out


def ascii_only(e: str) -> str:
    return f"regexp_replace(coalesce({e}, ''), '[^\\x00-\\x7F]', '', 'g')"


def ws_split(e: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({e}, ''), {lit(WS)}), lambda x: x <> '')"


def stop_list() -> str:
    return "[" + ", ".join(lit(w) for w in STOP_WORDS) + "]"


def clean_tokens(e: str, stops: bool = True) -> str:
    alpha = f"list_transform(list_filter({ws_split(e)}, lambda x: regexp_full_match(x, '[A-Za-z]{{2,}}')), lambda x: lower(x))"
    if stops:
        return f"list_filter({alpha}, lambda x: NOT list_contains({stop_list()}, x))"
    return alpha


def review_words(e: str, remove_stop_words: bool = False) -> str:
    words = ws_split(f"lower({keep_rule(strip_html(e))})")
    if remove_stop_words:
        return f"list_filter({words}, lambda x: NOT list_contains({stop_list()}, x))"
    return words


def freq_tokens(e: str) -> str:
    return (f"list_filter(string_split(translate(lower(coalesce({e}, '')), {lit(FREQ_FILTERS)}, "
            f"{lit(' ' * len(FREQ_FILTERS))}), ' '), lambda x: x <> '')")


def word_tokens(e: str) -> str:
    return f"regexp_extract_all(lower(coalesce({e}, '')), '[a-z0-9_]{{2,}}')"


def md5_int(seed, key: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT"


def md5_unit(seed, key: str) -> str:
    return f"(CAST({md5_int(seed, key)} AS DOUBLE) / CAST(4294967296 AS DOUBLE))"


def md5_key(seed, key: str) -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


def sentence_split(e: str) -> str:
    trimmed = "lambda s: regexp_replace(s, '^[ \\t\\n\\r\\f\\x0B]+|[ \\t\\n\\r\\f\\x0B]+$', '', 'g')"
    return (f"list_filter(list_transform(regexp_extract_all(coalesce({e}, ''), '[^.!?]+[.!?]*'), {trimmed}), "
            f"lambda s: length(s) > 0)")


def join_list(e: str) -> str:
    return f"array_to_string({e}, ' ')"
