"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every source's documents are laid end to end in a seeded order and cut into blocks of ``block`` words.  The
mix is dealt in shards of equal numbers of blocks; the seats of all shards go to sources by highest quotient
``target / (2 j - 1)``, so each shard has an integer quota of blocks per source, and (the method being house
monotone) the first k shards together are apportioned as exactly as one shard is.  Seat j of a source then
picks block ``(offset + j - 1) mod n_blocks`` with a seeded offset, and belongs to the shard that dealt it: a
shard's blocks of a source are the run of its quota's length that follows the run of the shard before.  Since
documents lie in seeded order, a run of blocks is a random choice of documents; at most two documents of a
source are taken in part, and a document on the border of two runs is in both shards, with its words in each.

A shard holds ``shard_blocks`` blocks (the last one the rest), or more on inputs where shards times sources
would exceed ``MAX_CELLS``: their quotas lie on the driver and in the closure of the tasks.  A block is one word,
so that no source has a part-filled block, however small it is; the cost does not grow with the seats.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating; they share ``budget`` times all
words, no target exceeding ``max_repeat`` times its source, the excess being shared again by weight.

Per-source figures (one row per source) go through the driver, at most ``MAX_SOURCES`` of them, else the
operator raises: weights per source are configuration.  Everything per document is one global running total
over (source, seeded key), range partitioned, so a hot source is spread like any other rows.

Null text has size 0; documents of size 0 are never taken (taken 0).  Rows with equal ids and texts have the
same size and key, so their order does not matter.  Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import dense_index, running_total
from .common import WORD, fresh, materialize
from .exact_dedup import RepeatFilter

WEIGHTS = (5.0, 2.0, 1.0)
MAX_SOURCES = 100_000
BLOCK = 1
SHARD_BLOCKS = 1 << 20
MAX_CELLS = 1_000_000  # quotas (one per shard and source) that one mix may have


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@dataclass
class Quota:
    source: str | None
    size: int       # words
    target: float   # words
    blocks: int     # blocks of the source
    seats: int      # blocks that the mix takes, repeats counted
    offset: int     # first block of the run
    quotas: list[int] = field(default_factory=list)  # the seats by shard


def targets(sizes: list[int], weights: list[float], budget: float, max_repeat: float) -> list[float]:
    """Share ``budget`` by weight; no share above ``max_repeat`` times its size, the excess reshared."""
    out = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    rest = budget
    while open_:
        w = sum(weights[i] for i in open_)
        over = [i for i in open_ if rest * weights[i] / w > max_repeat * sizes[i]]
        if not over:
            for i in open_:
                out[i] = rest * weights[i] / w
            break
        for i in over:
            out[i] = max_repeat * sizes[i]
            rest -= out[i]
        closed = set(over)
        open_ = [i for i in open_ if i not in closed]
    return out


def sainte_lague(shares: list[float], seats: int, caps: list[int]) -> list[int]:
    """Seats by highest quotient share/(2j-1), none above its cap; ties to the earlier source.

    The threshold quotient is found by bisection, so the cost does not grow with the number of seats.
    """
    seats = min(seats, sum(c for s, c in zip(shares, caps) if s > 0))

    def held(q: float) -> list[int]:  # seats whose quotient is >= q
        return [min(c, int((s / q + 1) // 2)) if s > 0 else 0 for s, c in zip(shares, caps)]

    if seats <= 0:
        return [0] * len(shares)
    high = max(shares) * 2.0
    low = min(s / (2 * c + 1) for s, c in zip(shares, caps) if s > 0 and c > 0) / 2
    for _ in range(200):  # invariant: held(low) >= seats > held(high)
        mid = math.sqrt(low * high)
        if not low < mid < high:
            break
        if sum(held(mid)) >= seats:
            low = mid
        else:
            high = mid
    out = held(high)
    rest = seats - sum(out)
    order = sorted((i for i in range(len(shares)) if shares[i] > 0 and out[i] < caps[i]),
                   key=lambda i: (-shares[i] / (2 * out[i] + 1), i))
    for i in order[:rest]:
        out[i] += 1
    return out


def shard_quotas(shares: list[float], seats: int, caps: list[int], shard_blocks: int = SHARD_BLOCKS):
    """Per shard the integer quota of each source: differences of the apportionments of the first k shards."""
    before = [0] * len(shares)
    for upto in range(shard_blocks, seats + shard_blocks, shard_blocks):
        now = sainte_lague(shares, min(upto, seats), caps)
        yield [a - b for a, b in zip(now, before)]
        before = now


def plan(sizes: dict[str | None, int], weights=WEIGHTS, share: float = 1.5, max_repeat: int = 2,
         block: int = BLOCK, seed: int = 42, shard_blocks: int = SHARD_BLOCKS) -> list[Quota]:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))  # Python compares strings by code point
    n = [sizes[s] for s in names]
    goal = targets(n, [float(weights[i % len(weights)]) for i in range(len(n))], share * sum(n), max_repeat)
    blocks = [-(-k // block) for k in n]
    caps = [max_repeat * b for b in blocks]
    seats = min(round(sum(goal) / block), sum(c for g, c in zip(goal, caps) if g > 0))
    shard_blocks = max(shard_blocks, math.ceil(seats / max(1, MAX_CELLS // max(1, len(n)))))
    shards = list(shard_quotas(goal, seats, caps, shard_blocks))

    def offset(s, b):
        return int.from_bytes(hashlib.sha256(f"{seed}\0{s!r}".encode()).digest()[:8], "big") % b if b else 0

    by_source = [[q[i] for q in shards] for i in range(len(n))]
    return [Quota(s, k, g, b, sum(q), offset(s, b), q) for s, k, g, b, q in zip(names, n, goal, blocks, by_source)]


def _run_words(begin: Column, end: Column, lo: Column, hi: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end, hi) - F.greatest(begin, lo))


def shard_parts(cuts: np.ndarray, n_shards: int, base, begin, end, lo, ring, seats):
    """Per row the words that each shard takes of it: (row, shard, words), by row and shard.

    The rows lie at ``begin`` to ``end`` on a ring of ``ring`` words; the seats cover ``seats`` words from
    ``lo`` on, turn after turn.  ``cuts`` has the first word of every (source, shard) on one axis where the
    seats of the sources follow each other; ``base`` is the first word of the row's source there.
    """
    rows, starts, ends = [], [], []
    turns = int(np.max(-(-seats // np.maximum(ring, 1)), initial=0))
    for turn in range(turns):
        for a, b in ((np.maximum(begin - lo, 0), end - lo), (begin - lo + ring, np.minimum(end - lo, 0) + ring)):
            a, b = a + turn * ring, np.minimum(b + turn * ring, seats)
            some = np.flatnonzero(b > a)
            rows.append(some)
            starts.append((a + base)[some])
            ends.append((b + base)[some])
    if not rows:
        none = np.zeros(0, np.int64)
        return none, none, none
    row, start, end = np.concatenate(rows), np.concatenate(starts), np.concatenate(ends)
    first = np.searchsorted(cuts, start, "right") - 1
    many = np.searchsorted(cuts, end, "left") - first
    at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
    upto = np.append(cuts[1:], np.iinfo(np.int64).max)
    words = np.minimum(np.repeat(end, many), upto[at]) - np.maximum(np.repeat(start, many), cuts[at])
    row, shard = np.repeat(row, many)[words > 0], (at % n_shards)[words > 0]
    cell, where = np.unique(row * n_shards + shard, return_inverse=True)
    total = np.zeros(len(cell), np.int64)
    np.add.at(total, where, words[words > 0])
    return cell // n_shards, cell % n_shards, total


def _shards_of(quotas: list[Quota], block: int):
    """Column function: array<struct<shard,words>> of a row, in shard order."""
    n_shards = max([1, *(len(q.quotas) for q in quotas)])
    per = np.zeros((len(quotas), n_shards), np.int64)
    for i, q in enumerate(quotas):
        per[i, :len(q.quotas)] = q.quotas
    flat = per.ravel() * block
    cuts = np.cumsum(flat) - flat

    @F.arrow_udf("array<struct<shard:int,words:long>>")
    def shards(base: pa.Array, begin: pa.Array, end: pa.Array, lo: pa.Array, ring: pa.Array, seats: pa.Array) -> pa.Array:
        cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in (base, begin, end, lo, ring, seats)]
        row, shard, words = shard_parts(cuts, n_shards, *cols)
        offsets = np.searchsorted(row, np.arange(len(base) + 1)).astype(np.int32)
        items = pa.StructArray.from_arrays([pa.array(shard, pa.int32()), pa.array(words, pa.int64())], ["shard", "words"])
        return pa.ListArray.from_arrays(pa.array(offsets), items)

    return shards, cuts[::n_shards].tolist()


def seeded_key(id_: Column, text: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("\0", F.lit(str(seed)), id_.cast("string"), F.md5(F.coalesce(text, F.lit("")))))


def mix(df: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", weights=WEIGHTS,
        share: float = 1.5, max_repeat: int = 2, block: int = BLOCK, seed: int = 42,
        shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """One row per row of ``df``: id, size, source, source_size, target, taken (words, repeats counted), shards, key.

    ``shards`` array<struct<shard,words>> lists the shards that take words of the row; the words add up to ``taken``.
    """
    spark = df.sparkSession
    sized = df.select(F.col(id_col).alias("id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
                      seeded_key(F.col(id_col), F.col(text), seed).alias("key"))
    sized = materialize(sized, "mix-sized")  # the range partitioning reads its input twice: not the texts
    order = [F.col("source").isNull(), F.col("source"), F.col("key"), F.col("id"), F.col("size")]
    placed = running_total(sized, order, "size", "upto")
    placed = placed.checkpoint(eager=True)
    per = placed.groupBy("source").agg(F.sum("size").alias("n"), F.min("upto").alias("first"))
    found = per.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: give coarser ones")
    first = {r["source"]: r["first"] for r in found}
    quotas = plan({r["source"]: r["n"] for r in found}, weights, share, max_repeat, block, seed, shard_blocks)
    shards, bases = _shards_of(quotas, block)
    rows = [(q.source, q.size, float(q.target), first[q.source], q.seats // q.blocks if q.blocks else 0,
             q.offset * block, (q.seats % q.blocks if q.blocks else 0) * block, q.blocks * block,
             q.seats * block, base) for q, base in zip(quotas, bases)]
    q = spark.createDataFrame(rows, "q_source string, source_size long, target double, first long, whole long, "
                                    "lo long, run long, ring long, seats long, base long")
    j = placed.join(F.broadcast(q), F.col("source").eqNullSafe(F.col("q_source")), "left")
    begin = F.col("upto") - F.col("first")
    end = begin + F.col("size")
    lo, hi, ring = F.col("lo"), F.col("lo") + F.col("run"), F.col("ring")
    taken = (F.col("whole") * F.col("size") + _run_words(begin, end, lo, hi)
             + _run_words(begin, end, F.lit(0), hi - ring))  # the run may wrap around the ring
    return j.select(F.col("id").alias(id_col), "size", "source", "source_size", "target",
                    taken.cast("long").alias("taken"),
                    shards("base", begin, end, lo, ring, "seats").alias("shards"), "key")


def _copy_shards(copies: Column) -> Column:
    """The shard of each whole copy: the one that holds the middle word of the copy's share of the taken words."""
    def shard(t):
        middle = F.floor((2 * t + 1) * F.col("taken") / (2 * copies))
        return F.aggregate("shards", F.struct(F.lit(0).cast("long").alias("upto"), F.lit(None).cast("int").alias("shard")),
                           lambda a, p: F.struct((a["upto"] + p["words"]).alias("upto"),
                                                 F.when(a["upto"] <= middle, p["shard"]).otherwise(a["shard"]).alias("shard")),
                           lambda a: a["shard"])
    return F.when(copies > 0, F.transform(F.sequence(F.lit(0), copies - 1), shard)).otherwise(F.array().cast("array<int>"))


def _numbered(rows: DataFrame, key: str, source: str, flt: RepeatFilter, name: str) -> DataFrame:
    """Add ``name``: 0, 1, ... among the rows of a key and source that ``flt`` holds, 0 for all other rows.

    Only rows of the filter move; those of one key are spread by a tie-breaker, however many they are.
    """
    maybe, tie, low, of, by = (fresh(rows, c) for c in ("maybe", "tie", "low", "of", "by"))
    cols = [F.col(f"`{c}`") for c in rows.columns]
    marked = flt.mark(rows, F.xxhash64(F.col(key)), maybe)
    alone = marked.where(~F.col(maybe)).select(*cols, F.lit(0).cast("long").alias(name))
    some = marked.where(F.col(maybe)).select(*cols, F.monotonically_increasing_id().alias(tie))
    some = dense_index(some, [F.col(key), F.col(f"`{source}`"), F.col(tie)], name)
    first = some.groupBy(F.col(key).alias(of), F.col(f"`{source}`").alias(by)).agg(F.min(name).alias(low))
    some = some.join(first, (F.col(key) == F.col(of)) & F.col(f"`{source}`").eqNullSafe(F.col(by)))
    return alone.unionByName(some.select(*cols, (F.col(name) - F.col(low)).cast("long").alias(name)))


def _own_names() -> dict[str, str]:
    """Names for the plan's columns that no column of a caller's table has."""
    mark = uuid.uuid4().hex[:12]
    return {c: f"_mix_{mark}_{c}" for c in ("key", "source", "shards", "hash", "nth", "copies", "rows", "total", "least", "most")}


def sharded_documents(df: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id",
                      seed: int = 42, shard: str = "shard", **how) -> DataFrame:
    """``mixed_documents`` with one more column: the shard that deals the copy.

    A document on a border goes, whole, to the shard of its middle word.  Documents of size 0 lie in no block
    (shard null).  Every row needs its shard, so here all texts are shuffled once; rows that share a key are
    numbered on both sides, so that each is joined with one row of the plan.
    """
    own = _own_names()
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    given = F.when(F.col("size") == 0, F.array(F.lit(None).cast("int"))).otherwise(_copy_shards(copies))
    plan_ = materialize(mix(df, text, source, id_col, seed=seed, **how).select(
        F.col("key").alias(own["key"]), F.col("source").alias(own["source"]), given.alias(own["shards"])), "mix-shards")
    repeated = materialize(plan_.groupBy(own["key"], own["source"]).count().where("count > 1")
                           .select(F.xxhash64(own["key"]).alias(own["hash"])), "mix-repeated")
    flt = RepeatFilter.build(repeated, own["hash"], max(1, repeated.count()), least=1)
    key, nth = fresh(df, "key"), fresh(df, "nth")
    cols = [F.col(f"`{c}`") for c in df.columns]
    keyed = _numbered(df.withColumn(key, seeded_key(F.col(id_col), F.col(text), seed)), key, source, flt, nth)
    plan_ = _numbered(plan_, own["key"], own["source"], flt, own["nth"])
    joined = keyed.join(plan_, (keyed[key] == plan_[own["key"]]) & keyed[source].eqNullSafe(plan_[own["source"]])
                        & (keyed[nth] == plan_[own["nth"]]))
    return joined.select(*cols, F.explode(own["shards"]).alias(shard))


def mixed_documents(df: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id",
                    seed: int = 42, **how) -> DataFrame:
    """The mix as rows of ``df``: a document that the mix takes whole c times stands c times.

    At most two documents of a source are taken in part; those go to the nearer whole number.  Documents of
    size 0 weigh nothing and stay once.  Texts are not shuffled but for rows that are not taken exactly once:
    those are found by a Bloom filter and joined, all others pass straight through.
    """
    own = _own_names()
    copies = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("int")
    plan_ = mix(df, text, source, id_col, seed=seed, **how).select(
        F.col("key").alias(own["key"]), F.col("source").alias(own["source"]), copies.alias(own["copies"]))
    # rows equal in id, text and source share a key: their copies add up and are dealt to them evenly
    odd = materialize(plan_.groupBy(own["key"], own["source"]).agg(
        F.count(F.lit(1)).alias(own["rows"]), F.sum(own["copies"]).alias(own["total"]), F.min(own["copies"]).alias(own["least"]),
        F.max(own["copies"]).alias(own["most"])).where((F.col(own["least"]) != 1) | (F.col(own["most"]) != 1))
        .withColumn(own["hash"], F.xxhash64(own["key"])), "mix-odd")
    uneven = odd.where(F.col(own["least"]) != F.col(own["most"])).select(own["hash"])
    n_uneven = uneven.count()
    flt = RepeatFilter.build(odd, own["hash"], max(1, odd.count()), least=1)
    cols = [F.col(f"`{c}`") for c in df.columns]
    key, maybe = fresh(df, "key"), fresh(df, "maybe")
    keyed = flt.mark(df.withColumn(key, seeded_key(F.col(id_col), F.col(text), seed)), F.xxhash64(F.col(key)), maybe)
    alone = keyed.where(~F.col(maybe)).select(*cols)
    some, nth = keyed.where(F.col(maybe)).drop(maybe), fresh(df, "nth")
    if n_uneven:  # a run ends between rows that share a key
        some = _numbered(some, key, source, RepeatFilter.build(uneven, own["hash"], n_uneven, least=1), nth)
    else:
        some = some.withColumn(nth, F.lit(0).cast("long"))
    joined = some.join(odd, (some[key] == odd[own["key"]]) & some[source].eqNullSafe(odd[own["source"]]), "left")
    # row i of n stands floor((i + 1) total / n) - floor(i total / n) times
    n = F.coalesce(F.expr("(`{0}` + 1) * {1} div {2} - `{0}` * {1} div {2}".format(nth, own["total"], own["rows"])), F.lit(1)).cast("int")
    spread = joined.withColumn(own["copies"], F.explode(F.array_repeat(F.lit(0), n))).select(*cols)
    return alone.unionByName(spread)
