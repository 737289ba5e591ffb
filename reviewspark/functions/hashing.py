"""Deterministic pseudo-random values from keys.

Every "random" step (shuffle, sample, split, subsampling draws, synthetic
scores) is a pure function of ``(seed, key)`` built from ``md5``: reruns and
recomputed tasks after an executor loss give the same rows, no shuffle is
needed to draw, and the same expression exists in DuckDB for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import _col


def md5_key(seed, *keys) -> Column:
    """Hex md5 of ``'seed:key1:key2...'``: a uniform shuffle key."""
    parts = [F.lit(str(seed))] + [_col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def md5_int(seed, *keys) -> Column:
    """First 32 bits of the md5 key as a non-negative bigint."""
    return F.conv(F.substring(md5_key(seed, *keys), 1, 8), 16, 10).cast("bigint")


def md5_unit(seed, *keys) -> Column:
    """Uniform double in [0, 1) (exact: division by a power of two)."""
    return md5_int(seed, *keys) / F.lit(4294967296.0)


def md5_bucket(seed, key, buckets: int = 100) -> Column:
    return F.pmod(md5_int(seed, key), F.lit(buckets))
