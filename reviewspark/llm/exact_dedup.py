"""Exact dedup by two-pass Bloom filtering.  [native: DataFrame functions only]

Texts are equal when they are identical after replacing each run of ASCII white space by one space
(null counts as empty).  Equality is decided on the SHA-256 of that text.

Pass 1 reads the 64-bit keys and counts, map-side combined, how often each of the ``HASHES`` slots of
a Bloom filter is hit; only slots hit at least twice become bits.  A key can repeat only if *all* its
slots were hit twice, so a row with a clear bit is certainly unique.  Pass 2 tests every row against
the bits where it lies: rows that may repeat are shuffled and grouped exactly, all others pass
straight through to the output without moving.

The bits are packed in 4 KB bitmaps and broadcast.  The broadcast has a proven bound: keys are dealt
over at most ``MAX_ROUNDS`` filters by residue, none above ``max_filter_bytes`` (one byte per key:
``BITS_PER_KEY`` bits); each filter tests only the rows of its residue, and all rows are tested.  Beyond
512 million keys (at the defaults) the filters fill up: more unique rows then go the exact way, none is lost,
and the narrow rows that all take it in the end are 40 bytes each; raise ``max_filter_bytes`` before that.

Groups: null ids sort last; of exactly equal rows (same id, same text) one, chosen by the read
order, stays.  Hot groups (a text that holds a third of all rows) are safe: groups are built by
partial aggregates, and the join that hands the kept id back is one whose skewed partitions AQE can split.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, fresh, materialize

BITS_PER_KEY = 8
HASHES = 2
MAX_FILTER_BYTES = 64 << 20
MAX_ROUNDS = 8
_BITMAP_BITS = 32768  # bits in one bitmap of bitmap_construct_agg


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WS, " ")


def _slots(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


class RepeatFilter:
    """Bloom filters of the 64-bit keys seen at least twice, as packed bitmaps.

    ``bits`` is the size of one filter and ``bitmaps`` its table (round, bucket, bitmap); a filter holds at
    most ``max_filter_bytes``.
    """

    def __init__(self, bitmaps: DataFrame, bits: int, rounds: int):
        self.bitmaps, self.bits, self.rounds = bitmaps, bits, rounds

    @classmethod
    def build(cls, keys: DataFrame, key: str, n: int, least: int = 2,
              max_filter_bytes: int = MAX_FILTER_BYTES) -> "RepeatFilter":
        """``keys``: written table; ``n``: its rows; ``least``: hits a slot needs (1: a plain Bloom filter)."""
        rounds = min(MAX_ROUNDS, max(1, math.ceil(n * BITS_PER_KEY / 8 / max_filter_bytes)))
        per = max(1, math.ceil(n / rounds))
        bits = _BITMAP_BITS * max(1, math.ceil(per * BITS_PER_KEY / _BITMAP_BITS))
        bits = min(bits, max(_BITMAP_BITS, max_filter_bytes * 8 // _BITMAP_BITS * _BITMAP_BITS))
        k = F.col(key)
        hit = (keys.where(k.isNotNull())
               .select(cls._round_of(k, rounds).alias("round"), F.explode(F.array(*_slots(k, bits))).alias("slot"))
               .groupBy("round", "slot").count().where(F.col("count") >= least))
        # bitmap_bucket_number and bitmap_bit_position count from 1
        at = F.col("slot") + 1
        maps = (hit.groupBy("round", F.bitmap_bucket_number(at).alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap")))
        return cls(materialize(maps, "repeat-filter"), bits, rounds)

    @staticmethod
    def _round_of(key: Column, rounds: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(rounds)).cast("int")

    def mark(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        """Add boolean ``name``: the key's bits are all set (never false for a key that was hit ``least`` times).

        A row stays where it is: the bitmaps come to it, one broadcast (of bounded size) per round and hash.
        """
        k, r = fresh(df, "bloom_key"), fresh(df, "bloom_round")
        cols = [F.col(f"`{c}`") for c in df.columns]
        df = df.withColumn(k, key).withColumn(r, self._round_of(F.col(k), self.rounds))
        flag = F.col(k).isNotNull()
        parts = []
        for i, slot in enumerate(_slots(F.col(k), self.bits)):
            at, b = fresh(df, f"slot{i}"), fresh(df, f"bucket{i}")
            df = df.withColumn(at, slot + 1).withColumn(b, F.bitmap_bucket_number(F.col(at)))
            parts.append((at, b, fresh(df, f"map{i}")))
        for n in range(self.rounds):
            of = self.bitmaps.where(F.col("round") == n) if self.rounds > 1 else self.bitmaps
            for at, b, m in parts:
                m = f"{m}_{n}"
                side = F.broadcast(of.select(F.col("bucket").alias(b), F.col("bitmap").alias(m)))
                df = df.join(side, b, "left")
                pos = F.bitmap_bit_position(F.col(at))
                byte = F.conv(F.hex(F.expr(f"substring(`{m}`, cast(bitmap_bit_position(`{at}`) div 8 as int) + 1, 1)")),
                              16, 10).cast("int")
                hit = F.col(m).isNotNull() & (F.expr("0") != F.coalesce(
                    byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), F.pmod(pos, F.lit(8)).cast("int"))), F.lit(0)))
                flag = flag & ((F.col(r) != n) | hit)
        return df.withColumn(name, flag).select(*cols, name)


def fingerprints(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """Narrow table (row, id, sha, key), written once: the text is read a single time."""
    narrow = df.select(F.col(id_col).alias("id"), F.sha2(normalised(F.col(text)), 256).alias("sha"))
    narrow = narrow.select(F.monotonically_increasing_id().alias("row"), "id", F.unhex("sha").alias("sha"),
                           F.xxhash64("sha").alias("key"))
    return materialize(narrow, "text-sha")


def exact_classes(df: DataFrame, text: str = "text", id_col: str = "doc_id",
                  max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """One row per row of ``df``: id, keep_id, group_size, kept, text_sha256.

    Empty input: no rows.  Null text equals empty text.  Null ids: such a row keeps ``keep_id`` null only
    when its whole group has null ids.  Other columns of ``df``, whatever their names, are not read.
    """
    narrow = fingerprints(df, text, id_col)
    n = narrow.count()
    flt = RepeatFilter.build(narrow, "key", n, max_filter_bytes=max_filter_bytes)
    marked = flt.mark(narrow, F.col("key"), "maybe")
    alone = marked.where(~F.col("maybe")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    repeated = marked.where("maybe").drop("maybe", "key")
    # written, so that the join deals both sides anew and AQE can split the partition of a hot text
    groups = materialize(repeated.groupBy("sha").agg(
        F.min(F.struct(F.col("id").isNull().alias("null"), "id", "row")).alias("first"),
        F.count(F.lit(1)).alias("group_size")), "text-groups")
    back = repeated.join(groups, "sha").select(
        "id", F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "sha")
    return alone.unionByName(back).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(df: DataFrame, text: str = "text", id_col: str = "doc_id",
                      max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """``df`` without its exact copies, same columns: of equal texts the row with the smallest id stays.

    Rows whose text certainly occurs once pass straight through; the others are reduced to one row per text
    by a map-side combined ``min_by``, so a hot text sends one row per task.
    """
    narrow = fingerprints(df, text, id_col)
    flt = RepeatFilter.build(narrow, "key", narrow.count(), max_filter_bytes=max_filter_bytes)
    sha, maybe = fresh(df, "sha"), fresh(df, "maybe")
    cols = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.withColumn(sha, F.sha2(normalised(F.col(text)), 256))
    marked = flt.mark(keyed, F.xxhash64(F.col(sha)), maybe)
    alone = marked.where(~F.col(maybe)).select(*cols)
    row = F.struct(*cols)
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.xxhash64(*cols))
    one = (marked.where(F.col(maybe)).groupBy(sha).agg(F.min_by(row, order).alias("row")).select("row.*"))
    return alone.unionByName(one)
