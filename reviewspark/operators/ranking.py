"""Global ranks and running totals without a single-partition window.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Here the rows are range-partitioned on the order key and sorted inside each
partition; ``monotonically_increasing_id`` then carries (partition, position)
and a table with one row per partition (bounded by the partition count, so it
is safe to broadcast) supplies each partition's offset.

The range bounds come from sampling the input, and a re-evaluated input (a
second branch of the plan, a retried stage) may arrive in another order and
be cut differently.  The tagged rows are therefore checkpointed to the
shared checkpoint folder once, and both the per-partition counts and the
final ranks are read from that single copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW_BITS = 33  # monotonically_increasing_id: partition id << 33 | row number


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def _ranged(df: DataFrame, order: list[Column], num_partitions: int | None) -> DataFrame:
    n = _partitions(df, num_partitions)
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = (ranged.withColumn("_pid", F.shiftright("_mid", _LOW_BITS))
                    .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
                    .drop("_mid"))
    ensure_checkpoint_dir(df.sparkSession)
    return tagged.checkpoint(eager=True)


def dense_index(df: DataFrame, order: list[Column], name: str = "idx", start: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = position of the row in the total order ``order`` (``start``-based).

    ``order`` must be a total order (ties broken) for the result to be
    deterministic.
    """
    ranged = _ranged(df, order, num_partitions)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    out = (ranged.join(F.broadcast(offsets), "_pid")
                 .withColumn(name, F.col("_off") + F.col("_loc") + F.lit(start))
                 .drop("_pid", "_loc", "_off"))
    return out


def running_total(df: DataFrame, order: list[Column], value: str, name: str = "cum_before",
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = sum of ``value`` over all rows strictly before this one in ``order``."""
    ranged = _ranged(df, order, num_partitions)
    totals = ranged.groupBy("_pid").agg(F.sum(value).alias("_t"))
    offsets = totals.select(
        "_pid",
        F.coalesce(F.sum("_t").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    local = Window.partitionBy("_pid").orderBy("_loc").rowsBetween(Window.unboundedPreceding, -1)
    out = (ranged.withColumn("_in", F.coalesce(F.sum(value).over(local), F.lit(0)))
                 .join(F.broadcast(offsets), "_pid")
                 .withColumn(name, F.col("_off") + F.col("_in"))
                 .drop("_pid", "_loc", "_off", "_in"))
    return out
