"""Join helpers with an explicit broadcast policy.

A side is hinted for broadcast only when its row count has a proven bound
(a capped vocabulary, a fixed word list, a one-row scalar) that fits the
budget.  Otherwise no hint is given: AQE measures the finished shuffle stage
and demotes the join to a broadcast only when the measured size is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond it the join stays a
sort-merge join whose skewed partitions (hot tokens) AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# what we accept to broadcast when the bound is proven (a cap) or checked: both rows and bytes
BROADCAST_ROW_BUDGET = 1_000_000
BROADCAST_BYTE_BUDGET = 128 << 20


def measured(small: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a written table: one partial + final aggregate, one row per task.

    Bytes count the text and binary columns in full, 8 bytes an array element, 16 bytes a row for every column besides.
    """
    wide = [F.octet_length(c) for c, t in small.dtypes if t in ("string", "binary")]
    wide += [8 * F.size(c) for c, t in small.dtypes if t.startswith("array")]
    size = sum((F.coalesce(c, F.lit(0)) for c in wide), F.lit(16 * len(small.columns)))
    r = small.agg(F.count(F.lit(1)).alias("n"), F.sum(size.cast("long")).alias("b")).first()
    return r["n"], r["b"] or 0


def fits(small: DataFrame, max_rows: int = BROADCAST_ROW_BUDGET, max_bytes: int = BROADCAST_BYTE_BUDGET) -> bool:
    rows, size = measured(small)
    return rows <= max_rows and size <= max_bytes


def lookup(big: DataFrame, small: DataFrame, on, how: str = "inner", bound_rows: int | None = None,
           check: bool = False, max_rows: int = BROADCAST_ROW_BUDGET, max_bytes: int = BROADCAST_BYTE_BUDGET) -> DataFrame:
    """Join ``big`` to a lookup table.  ``bound_rows`` is a bound known by construction (a cap).  With
    ``check=True`` the lookup side is written once and measured in rows and bytes.  Within the budget it is
    broadcast (the big side is not shuffled at all); beyond it, a shuffle join (AQE splits skewed partitions)."""
    if bound_rows is not None and bound_rows <= max_rows:
        return big.join(F.broadcast(small), on, how)
    if check:
        from ..session import materialize
        small = materialize(small, "lookup")
        if fits(small, max_rows, max_bytes):
            small = F.broadcast(small)
    return big.join(small, on, how)


def skew_split_join(big: DataFrame, small: DataFrame, key: str, key_counts: DataFrame,
                    count_col: str = "n", max_hot: int = 10_000, how: str = "inner") -> DataFrame:
    """Join with hot keys split off, exactly.

    ``key_counts(key, n)`` gives the rows per key on the big side.  A key is
    hot when it holds at least ``1/max_hot`` of all rows, so there are at
    most ``max_hot`` hot keys (a proven bound): their rows of ``small`` are
    broadcast and the big side's hot rows join them map-side, never
    gathering one key in one task.  All other keys go through an ordinary
    shuffle join in which no key is hot.  The union is the full join.
    """
    total = key_counts.select(F.sum(count_col)).scalar()
    hot_keys = key_counts.where(F.col(count_col) * F.lit(max_hot) >= total).select(key)
    hot = F.broadcast(hot_keys)
    small_hot = small.join(hot, key, "left_semi")
    small_cold = small.join(hot, key, "left_anti")
    big_hot = big.join(hot, key, "left_semi").join(F.broadcast(small_hot), key, how)
    big_cold = big.join(hot, key, "left_anti").join(small_cold, key, how)
    return big_hot.unionByName(big_cold)
