"""Exact top-k inner-product search over vector-approximation files.

Every component x becomes the integer floor(scale * x).  Three tables are written:

* the vectors: each different vector once, with the k + 1 rows of smallest id that hold it (more can never be among
  the k best of a query), so that a vector which stands in a third of all rows is one candidate;
* the approximation file: per vector a cell number per component (one byte; cell marks are equal steps between the
  component's smallest and largest value over the whole table);
* the queries, numbered by a distributed rank.

Queries (their number grows with the table) are handled in blocks of ``QUERY_BLOCK``, one after the other: a block is
sent to the tasks, answered, its rows written, and given back.  For a block

1. the tasks scan the cells alone and get a lower and an upper bound on every score; a vector stays a candidate while its
   upper bound reaches the (k + 1)-th largest lower bound of its query, first in the task, then over all tasks;
2. only the candidates' exact vectors are fetched, by a join with the vectors;
3. per query they are read in falling order of upper bound until the k-th best exact score is above the next bound: no
   other vector can then belong to the result.

Vectors that are null or hold a null or non-finite component take no part, neither as query nor as candidate.
Scores compare vectors of equal length only.  Rows are told apart by an internal number: a query's own row is no
candidate, another row with its id is one, and every query row of a repeated id gives its own k rows.  Ties go to
the smaller id, nulls last; rows with a null id are candidates but never queries.  Fewer than k candidates: all of
them.  Sums are exact while they stay below 2^53 in absolute value (components up to 2^23 at 64 dimensions).  Empty
table: no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import fits
from ..operators.ranking import dense_index
from .common import materialize, shared_path, shuffle_partitions

BITS = 8
CANDIDATES = 4096      # vectors scanned at a time
QUERY_BLOCK = 8192     # query vectors sent to the tasks at a time
STEP = 512             # queries whose bounds are held at a time


def integers(df: DataFrame, vector: str, id_col: str, scale: int) -> DataFrame:
    """(id, dim, v array<long>) of the vectors that take part."""
    x = F.col(vector)
    ok = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (df.where(x.isNotNull() & ok)
            .select(F.col(id_col).cast("long").alias("id"), F.size(x).alias("dim"),
                    F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long")).alias("v")))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """Written: vec, dim, v, members (the k + 1 rows of smallest id; the limit works before the shuffle too)."""
    order = Window.partitionBy("v").orderBy(F.asc_nulls_last("id"), "row")
    some = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1)
    per = some.groupBy("v").agg(F.first("dim").alias("dim"), F.min("row").alias("vec"), F.collect_list(F.struct("id", "row")).alias("members"))
    return materialize(per.select("vec", "dim", "v", "members"), "va-vectors")


def build_index(vectors: DataFrame, bits: int = BITS) -> tuple[DataFrame, dict]:
    """The written approximation file (vec, dim, cells) and the marks {dim: (lowest, step) per component}."""
    # one row per (dim, component): bounded by the vector's length
    ends = (vectors.select("dim", F.posexplode("v").alias("at", "x")).groupBy("dim", "at")
            .agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
    marks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d in {r["dim"] for r in ends}:
        lo, hi = np.zeros(d, np.int64), np.zeros(d, np.int64)
        for r in ends:
            if r["dim"] == d:
                lo[r["at"]], hi[r["at"]] = r["lo"], r["hi"]
        marks[d] = (lo, (hi - lo) // (1 << bits) + 1)

    def cut(batches):
        import pyarrow as pa
        for b in batches:
            cells = []
            for v in b.column(2).to_pylist():
                lo, step = marks.get(len(v), (np.zeros(0, np.int64),) * 2)
                cells.append(((np.array(v, np.int64) - lo) // step).astype(np.uint8).tobytes() if v else b"")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cells, pa.binary())], ["vec", "dim", "cells"])

    return materialize(vectors.select("vec", "dim", "v").mapInArrow(cut, "vec long, dim int, cells binary"), "va-index"), marks


def bounds(q: np.ndarray, cells: np.ndarray, lo: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of the scores of the queries ``q`` (rows) with the vectors of ``cells``, exact in doubles."""
    low = (lo + cells * step).astype(float)      # smallest value of each cell
    wide = (step - 1).astype(float)              # and how much larger the value may be
    qf = q.astype(float)
    base = qf @ low.T
    return base + (np.minimum(qf, 0) @ wide)[:, None], base + (np.maximum(qf, 0) @ wide)[:, None]


def _scan(sent, marks: dict, keep: int):
    """mapInArrow over the approximation file: (place, vec, lower, upper) of the vectors that may be among a query's
    ``keep`` best, as far as this task knows."""
    def run(batches):
        import pyarrow as pa

        best: dict = {}  # (dim, place of the query in its group) -> (vec, lower, upper), pruned as it grows
        for b in batches:
            dims, vec_all, cells_all = b.column("dim").to_numpy(), b.column("vec").to_numpy(), b.column("cells")
            for d, (_, q) in sent.value.items():
                rows = np.flatnonzero(dims == d)
                lo, step = marks.get(d, (np.zeros(0, np.int64),) * 2)
                for a in range(0, len(rows), CANDIDATES):
                    r = rows[a:a + CANDIDATES]
                    cells = np.frombuffer(b"".join(cells_all.take(pa.array(r)).to_pylist()), np.uint8).reshape(len(r), d).astype(np.int64)
                    vec = vec_all[r]
                    for s in range(0, len(q), STEP):
                        lower, upper = bounds(q[s:s + STEP], cells, lo, step)
                        kk = min(keep, len(r))
                        known = np.partition(lower, -kk, axis=1)[:, -kk]
                        for i in range(len(lower)):
                            key = (d, s + i)
                            held = best.get(key)
                            t = known[i] if kk == keep else -np.inf
                            if held is not None:
                                t = max(t, held[3])
                            far = np.flatnonzero(upper[i] >= t)
                            if held is None:
                                v, lw, up = vec[far], lower[i][far], upper[i][far]
                            elif len(far):
                                v, lw, up = (np.concatenate(x) for x in zip(held[:3], (vec[far], lower[i][far], upper[i][far])))
                            else:
                                continue
                            if len(lw) >= keep:
                                t = max(t, np.partition(lw, -keep)[-keep])
                                some = up >= t
                                v, lw, up = v[some], lw[some], up[some]
                            best[key] = (v, lw, up, t)
        for (d, i), (v, lw, up, _) in best.items():
            place = sent.value[d][0][i]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), place)), pa.array(v), pa.array(lw), pa.array(up)],
                                             ["place", "vec", "lower", "upper"])

    return run


def candidates(index: DataFrame, sent, marks: dict, k: int) -> DataFrame:
    """Written: (place, vec, upper) of the vectors whose upper bound reaches their query's (k + 1)-th largest lower bound.

    The query's own vector may be one of these, hence k + 1: k others then reach that bound.
    """
    found = materialize(index.mapInArrow(_scan(sent, marks, k + 1), "place long, vec long, lower double, upper double"), "va-bounds")
    w = Window.partitionBy("place").orderBy(F.desc("lower"))
    top = found.select("place", "lower").withColumn("n", F.row_number().over(w)).where(F.col("n") <= k + 1)
    least = top.groupBy("place").agg(F.when(F.count(F.lit(1)) == k + 1, F.min("lower")).alias("least"))  # a row a query of the block
    near = found.join(F.broadcast(least), "place").where(F.col("least").isNull() | (F.col("upper") >= F.col("least")))
    return materialize(near.select("place", "vec", "upper"), "va-candidates")


def _exact(sent, k: int):
    """mapInArrow over (place, upper, v, members), by place and falling upper bound: the k best rows of every query."""
    def run(batches):
        import pyarrow as pa

        query = {int(p): v for places, q in sent.value.values() for p, v in zip(places, q)}
        place, best, out, over = None, [], [], False

        def close():
            out.extend((place, i if known else None, -s) for s, _, i, _, known in best)

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("place", "own", "upper", "v", "members")]
            for p, own, upper, v, members in zip(*cols):
                if p != place:
                    if place is not None:
                        close()
                    place, best, over = p, [], False
                # a bound equal to the k-th score may still win by its id
                over = over or (len(best) == k and -best[-1][0] > upper)
                if over:
                    continue
                s = int(np.array(v, np.int64) @ query[p])
                best += [(-s, m["id"] is None, m["id"] or 0, m["row"], m["id"] is not None) for m in members if m["row"] != own]
                best.sort()
                del best[k:]
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], pa.int64()) for j in range(3)], ["place", "id", "score"])
                out.clear()
        if place is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], pa.int64()) for j in range(3)], ["place", "id", "score"])

    return run


def top_k(df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", k: int = 5, every: int = 50,
          scale: int = 256, bits: int = BITS) -> DataFrame:
    """Rows (query_id, rank, id, score): for each row whose id is divisible by ``every`` its k best others."""
    spark = df.sparkSession
    rows = materialize(integers(df, vector, id_col, scale).select(F.monotonically_increasing_id().alias("row"), "*"), "va-integers")
    vectors = distinct_vectors(rows, k)
    index, marks = build_index(vectors, bits)
    asked = dense_index(rows.where(F.pmod(F.col("id"), F.lit(every)) == 0), [F.asc("row")], name="place", start=0)
    asked = materialize(asked.withColumn("block", F.floor(F.col("place") / QUERY_BLOCK)), "va-queries")
    folder = shared_path(spark, "va-results")
    schema = f"query_id long, rank int, {id_col} long, score long"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/block=-1")
    for at in range(-(-asked.count() // QUERY_BLOCK)):
        _answer(asked.where(F.col("block") == at), vectors, index, marks, k, id_col).write.mode("overwrite").parquet(f"{folder}/block={at}")
    return spark.read.schema(schema).parquet(f"{folder}/block=*").select("query_id", "rank", id_col, "score")


def _answer(block: DataFrame, vectors: DataFrame, index: DataFrame, marks: dict, k: int, id_col: str) -> DataFrame:
    """The results of one block of queries (at most ``QUERY_BLOCK`` rows)."""
    spark = block.sparkSession
    queries: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    found = block.select("place", "dim", "v").toArrow()
    dims, places, v = found["dim"].to_numpy(), found["place"].to_numpy(), found["v"].to_pylist()
    for d in sorted(set(dims.tolist())):
        some = np.flatnonzero(dims == d)
        queries[d] = (places[some].astype(np.int64), np.array([v[i] for i in some], np.int64).reshape(len(some), d))
    sent = spark.sparkContext.broadcast(queries)
    near = candidates(index, sent, marks, k)
    owners = F.broadcast(block.select("place", F.col("row").alias("own"), F.col("id").alias("query_id")))  # the block
    wanted = near.join(owners.drop("query_id"), "place")
    held = (F.broadcast(wanted) if fits(near) else wanted).join(vectors.select("vec", "v", "members"), "vec")
    dealt = (held.select("place", "own", "upper", "v", "members").repartition(shuffle_partitions(spark), "place")
             .sortWithinPartitions("place", F.desc("upper")))
    best = dealt.mapInArrow(_exact(sent, k), "place long, id long, score long")
    w = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (best.withColumn("rank", F.row_number().over(w).cast("int")).join(owners.drop("own"), "place")
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
