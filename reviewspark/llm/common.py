"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bounded_batches, ensure_checkpoint_dir, materialize, shared_path  # noqa: F401  (re-exported)

# ASCII white space as every contract of this subpackage means it
WS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet (so extra columns never clash)."""
    have = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in have:
        name = f"_{stem}_{uuid.uuid4().hex[:6]}"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def worker_memory() -> dict:
    """What a Python worker keeps between tasks.

    Package functions travel by value, so the globals of this package live only as long as one task.
    """
    import sys
    import types

    holder = sys.modules.setdefault("_kept_between_tasks", types.ModuleType("_kept_between_tasks"))
    return holder.__dict__.setdefault("kept", {})


def forget(*keep) -> None:
    """Give back what other operators kept in this worker (tokenizers and their memories), but for the names in ``keep``."""
    import ctypes
    import gc

    import pyarrow as pa

    kept = worker_memory()
    others = [k for k in kept if k not in keep]
    for k in others:
        del kept[k]
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # not glibc
            pass


def smallest(df: DataFrame, key, n: int, order: list) -> DataFrame:
    """The ``n`` rows of ``df`` that come first in ``order``, which begins with the hex hash ``key``.

    A plain ``orderBy().limit(n)`` sends n rows of every partition into one task.  A histogram of the hash's first four
    digits (65,536 rows at most) tells in which cell the n-th row lies; only rows up to that cell are sorted.
    """
    cell = F.conv(F.substring(key, 1, 4), 16, 10).cast("int")
    upto, last = 0, 0
    for r in sorted(df.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()):
        upto, last = upto + r["n"], r["cell"]
        if upto >= n:
            break
    return df.where(cell <= last).orderBy(*order).limit(n)
