"""Operators of a training-data pipeline: dedup, WARC, PII, toxicity, mixing, tokenizers, search, chat.

Nothing else in the library imports this subpackage.  ``queries`` holds the registered queries
(``opN_<name>``) and their SQL twins; every operator keeps a general interface of its own.
"""
