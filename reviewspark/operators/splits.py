"""Deterministic shuffles, samples and splits.

Randomness is a pure function of ``(seed, doc_id)`` (``functions.hashing``):
no ``rand()``, so splits are identical on rerun, on task retry and in the
SQL oracle.  Row-count-exact splits use the distributed global rank from
``ranking.dense_index``; the scalar ``N`` is a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import md5_bucket, md5_key
from .ranking import dense_index


def shuffle_order(seed, key: str = "doc_id"):
    return [md5_key(seed, key), F.col(key)]


def split_bucket(df: DataFrame, frac: float = 0.2, seed=42, key: str = "doc_id"):
    """Hash-bucket split: ``pmod(md5 bucket, 100) < frac*100`` is validation.

    No shuffle and no count; expected (not exact) fraction.  Returns
    ``(train, validation)``; together they are disjoint and exhaustive.
    """
    is_val = md5_bucket(seed, key, 100) < F.lit(int(round(frac * 100)))
    return df.where(~is_val), df.where(is_val)


def with_split_bucket(df: DataFrame, frac: float = 0.2, seed=42, key: str = "doc_id") -> DataFrame:
    is_val = md5_bucket(seed, key, 100) < F.lit(int(round(frac * 100)))
    return df.withColumn("split", F.when(is_val, "val").otherwise("train"))


def shuffle_key(seed, key: str = "doc_id"):
    """The seeded shuffle order as one comparable struct (md5 hex, then key)."""
    return F.struct(md5_key(seed, key).alias("h"), F.col(key).alias("k"))


BUCKETS = 1 << 16  # of the histograms below: a bound on their rows, whatever the table's size


def _md5_cell(seed, key: str) -> "F.Column":
    """The first four hex digits of the md5 key: a prefix of the shuffle order, 65,536 values."""
    return F.conv(F.substring(md5_key(seed, key), 1, 4), 16, 10).cast("long")


def _cell_at(cells: DataFrame, position) -> "F.Column":
    """``(cell, before)`` of the cell in which the running count of ``cells(cell)`` reaches ``position``.

    The histogram has at most ``BUCKETS`` rows, so the running sum over it is a bounded window.
    """
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    cum = hist.select("cell", "n", F.sum("n").over(upto).alias("upto")).where(F.col("upto") >= position)
    return cum.select(F.min(F.struct("cell", (F.col("upto") - F.col("n")).alias("before")))).scalar()


def downsample(df: DataFrame, n: int, seed=42, key: str = "doc_id") -> DataFrame:
    """Seeded shuffle, then the first ``n`` rows.

    A plain ``orderBy().limit(n)`` sends ``n`` rows per input partition into one task.  A histogram of the md5
    key's first four digits tells in which cell the n-th row lies; only rows up to that cell (``n`` and a
    65,536th of the table at most, in expectation) enter the top n.  One plan, exact at every size.
    """
    last = _cell_at(df.select(_md5_cell(seed, key).alias("cell")), F.lit(n))["cell"]
    cand = df.where(_md5_cell(seed, key) <= F.coalesce(last, F.lit(BUCKETS)))
    return cand.orderBy(*shuffle_order(seed, key)).limit(n)


def _n(df: DataFrame):
    return df.select(F.count(F.lit(1))).scalar()


def key_at(df: DataFrame, key_col, cell, position) -> "F.Column":
    """The order key found at 1-based ``position`` (a scalar subquery).

    ``cell`` is a long that rises with the key and takes at most ``BUCKETS`` values.  Its histogram gives the cell
    of the boundary; only that cell's keys are ranked.  A split of a wide table becomes a predicate
    ``key <= boundary`` on the original rows: no sort of all keys, no join back, no copy of the wide columns.
    """
    narrow = df.select(key_col.alias("_key"), cell.alias("cell"))
    at = _cell_at(narrow, position)
    inside = narrow.where(F.col("cell") == at["cell"]).select("_key", (position - at["before"]).alias("_want"))
    ranked = dense_index(inside, [F.col("_key")], name="_r")
    return ranked.where(F.col("_r") == F.col("_want")).select(F.min("_key")).scalar()


def _even_cell(df: DataFrame, key: str) -> "F.Column":
    """``BUCKETS`` equal steps between the smallest and largest value of a number column (null: first cell)."""
    ends = df.select(F.min(key).alias("lo"), F.max(key).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    step = (F.col(key) - lo).cast("double") / F.greatest((hi - lo).cast("double"), F.lit(1.0)) * F.lit(BUCKETS - 1)
    return F.coalesce(F.floor(step), F.lit(0)).cast("long")


def with_split_tail(df: DataFrame, frac: float = 0.2, seed=42, key: str = "doc_id") -> DataFrame:
    """Seeded shuffle; the last ``int(frac*N)`` rows are validation."""
    ks = shuffle_key(seed, key)
    n = _n(df)
    cut = n - F.floor(F.lit(float(frac)) * n)            # last training rank
    is_val = F.when(cut < 1, F.lit(True)).otherwise(F.coalesce(ks > key_at(df, ks, _md5_cell(seed, key), cut), F.lit(True)))
    return df.withColumn("split", F.when(is_val, "val").otherwise("train"))


def with_split_exact(df: DataFrame, frac: float = 0.2, seed=42, key: str = "doc_id") -> DataFrame:
    """Exactly ``round(frac*N)`` (half to even) rows in validation (the first ones
    in the seeded order)."""
    ks = shuffle_key(seed, key)
    n_val = F.bround(F.lit(float(frac)) * _n(df), 0)
    is_val = F.when(n_val < 1, F.lit(False)).otherwise(F.coalesce(ks <= key_at(df, ks, _md5_cell(seed, key), n_val), F.lit(False)))
    return df.withColumn("split", F.when(is_val, "val").otherwise("train"))


def with_split_tail_ordered(df: DataFrame, frac: float = 0.2, key: str = "doc_id") -> DataFrame:
    """No shuffle: the first ``int(N*(1-frac))`` rows by ``key`` train, the rest validate."""
    ks = F.struct(F.col(key).alias("k"))
    n_train = F.floor(_n(df) * F.lit(1.0 - frac))
    is_train = F.when(n_train < 1, F.lit(False)).otherwise(F.coalesce(ks <= key_at(df, ks, _even_cell(df, key), n_train), F.lit(False)))
    return df.withColumn("split", F.when(is_train, "train").otherwise("val"))


def split_complement(df: DataFrame, val: DataFrame, key: str = "doc_id") -> DataFrame:
    """Training rows = all rows without a validation row (anti-join on the key)."""
    return df.join(val.select(key), key, "left_anti")


def with_folds(df: DataFrame, k: int = 3, seed=42, label: str = "label", key: str = "doc_id",
               name: str = "fold") -> DataFrame:
    """Stratified folds: rows ordered by ``(label, seeded shuffle key)`` are
    dealt round-robin to ``k`` folds by their global rank.  A label's rows
    hold consecutive ranks, so within every label the fold sizes differ by at
    most one; no per-label window (a label can be a third of the data) and no
    join on the low-cardinality label column.
    """
    ranked = dense_index(df, [F.col(label)] + shuffle_order(seed, key), name="_g")
    return ranked.withColumn(name, F.pmod(F.col("_g") - F.lit(1), F.lit(k)).cast("int")).drop("_g")
