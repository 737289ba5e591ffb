"""Hard-negative mining by a vertical scan of vector dimensions (BOND).

Every component x becomes the integer floor(scale * x); a row's score is its integer inner product with the anchor.
For each anchor the ``positives`` best other rows of its label are found, then for each of these positives the
``negatives`` best rows of other labels whose score lies in the window ``low% .. 100%`` of the positive's score.

Vertical scan.  A task turns its rows into columns, one a dimension, with the smallest and largest value of each.
An anchor reads the dimensions in the order of its own components' falling magnitude, a few at a time, and adds up
partial scores.  The dimensions still unread can add at least and at most what their smallest and largest values
allow, so every row has a lower and an upper bound, and the set of candidate rows shrinks: for positives to those
whose upper bound reaches the k-th largest lower bound, for negatives to those that may lie in a window and reach the
k-th largest lower bound of the rows that surely lie in it.  When all dimensions are read (or none is left to rule
out) the scores are exact, so no bound ever decides a result.

Anchors are dealt into blocks of ``ANCHORS`` by a distributed rank.  One block after the other is sent to the tasks,
scanned twice (positives, then windows) over the written integer rows, and its rows written; the driver never holds
more than one block and its positives.  Tasks return k rows an anchor and window, which a window function merges.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part.  Ties go to the
smaller id, null ids last; a null id is never an anchor.  Rows are told apart by an internal number, so repeated ids
are rows of their own: another row with the anchor's id may be its positive, and every anchor row of an id gives its
own result rows.  Scores compare vectors of equal length.  A negative positive score has no window.  Fewer rows than
asked for: all of them; an empty table: no rows.  Sums are exact below 2^63.  Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import dense_index
from .common import materialize, shared_path

ANCHORS = 2048   # anchors sent to the tasks at a time
STEP = 8         # dimensions read between two looks at the bounds


def integer_rows(df: DataFrame, vector: str, id_col: str, label: str, scale: int) -> DataFrame:
    """Written once: row, id, label, v array<long> of the rows that take part."""
    x = F.col(vector)
    whole = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    part = df.where(F.col(label).isNotNull() & x.isNotNull() & whole)
    v = F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long"))
    return materialize(part.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                                   F.col(label).cast("long").alias("label"), v.alias("v")), "mining-rows")


class Columns:
    """Some rows as columns: ``x[d]`` holds dimension d of all rows, beside each dimension's smallest and largest."""

    def __init__(self, rows: np.ndarray, v: np.ndarray):
        self.rows = rows                                  # places of the rows in the task's batch
        self.x = np.ascontiguousarray(v.T)
        self.low = self.x.min(1) if v.size else np.zeros(v.shape[1], np.int64)
        self.high = self.x.max(1) if v.size else np.zeros(v.shape[1], np.int64)
        self.most = int(max(np.abs(self.low).max(initial=0), np.abs(self.high).max(initial=0)))

    def scan(self, q: np.ndarray, places: np.ndarray, still):
        """(places, scores) of the rows among ``places`` that ``still(low, high)`` never ruled out."""
        # doubles add and multiply faster and are exact while every sum stays below 2^53
        kind = np.float64 if self.most * int(np.abs(q).sum()) < 1 << 53 else np.int64
        order = np.argsort(-np.abs(q), kind="stable")
        q = q.astype(kind)
        a, b = q * self.low.astype(kind), q * self.high.astype(kind)
        least = np.concatenate([np.cumsum(np.minimum(a, b)[order][::-1])[::-1], [0]])   # of the dimensions not yet read
        most = np.concatenate([np.cumsum(np.maximum(a, b)[order][::-1])[::-1], [0]])
        total = np.zeros(len(places), kind)
        for at in range(0, len(order), STEP):
            if not len(places):
                break
            dims = order[at:at + STEP]
            total = total + q[dims] @ self.x[dims][:, places].astype(kind)
            unread = min(at + STEP, len(order))
            keep = still(total + least[unread], total + most[unread])
            if keep is not None and not keep.all():
                places, total = places[keep], total[keep]
        return places, total.astype(np.int64)


def _kth(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def _merged(held: list, scores, ids, known, k: int) -> list:
    """The k best of ``held`` and the new rows: (-score, id is null, id)."""
    if len(scores) > 4 * k:   # only rows up to the k-th score can be among the best
        some = scores >= _kth(scores, k)
        scores, ids, known = scores[some], ids[some], known[some]
    return sorted(held + [(-s, not n, i if n else 0) for s, i, n in
                          zip(scores.tolist(), ids.tolist(), known.tolist())])[:k]


def _column_groups(batch):
    """(Columns, row, id, known, label) per vector length of an Arrow batch of integer rows."""
    row, label = batch.column("row").to_numpy(), batch.column("label").to_numpy()
    known = np.asarray(batch.column("id").is_valid())
    ids = batch.column("id").fill_null(0).to_numpy()
    v = batch.column("v")
    size = np.diff(v.offsets.to_numpy())
    for d in np.unique(size):
        places = np.flatnonzero(size == d)
        flat = v.take(places).flatten().to_numpy() if len(places) < len(size) else v.flatten().to_numpy()
        yield int(d), Columns(places, flat.reshape(len(places), d)), row[places], ids[places], known[places], label[places]


def _positives(sent, k: int):
    def run(batches):
        import pyarrow as pa

        anchors, best = sent.value, {}
        for b in batches:
            if not b.num_rows:
                continue
            for d, cols, row, ids, known, label in _column_groups(b):
                for i, (a_row, _, a_label, q) in enumerate(anchors):
                    places = np.flatnonzero((label == a_label) & (row != a_row)) if len(q) == d else np.empty(0, np.int64)
                    if not len(places):
                        continue
                    held = best.get(i, [])
                    floor = -held[k - 1][0] if len(held) == k else None

                    def still(low, high):
                        t = _kth(low, k)
                        t = floor if t is None else t if floor is None else max(t, floor)
                        return None if t is None else high >= t

                    at, s = cols.scan(q, places, still)
                    best[i] = _merged(held, s, ids[at], known[at], k)
        out = [(i, -s, None if null else rid) for i, rows in best.items() for s, null, rid in rows]
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], pa.int64()) for j in range(3)], ["anchor", "score", "id"])

    return run


def _negatives(sent, k: int):
    def run(batches):
        import pyarrow as pa

        anchors, best = sent.value, {}
        for b in batches:
            if not b.num_rows:
                continue
            for d, cols, _, ids, known, label in _column_groups(b):
                for i, (a_label, q, windows) in enumerate(anchors):
                    places = np.flatnonzero(label != a_label) if len(q) == d and windows else np.empty(0, np.int64)
                    if not len(places):
                        continue
                    held = [best.get((i, w), []) for w in range(len(windows))]
                    floors = [-h[k - 1][0] if len(h) == k else lo for h, (lo, _) in zip(held, windows)]

                    def still(low, high):
                        keep = np.zeros(len(low), bool)
                        for floor, (lo, hi) in zip(floors, windows):
                            t = _kth(low[(low >= lo) & (high <= hi)], k)
                            keep |= (high >= (floor if t is None else max(t, floor))) & (low <= hi)
                        return keep

                    at, s = cols.scan(q, places, still)
                    for w, (lo, hi) in enumerate(windows):
                        inside = (s >= lo) & (s <= hi)
                        if inside.any():
                            best[i, w] = _merged(held[w], s[inside], ids[at[inside]], known[at[inside]], k)
        out = [(i, w, -s, None if null else rid) for (i, w), rows in best.items() for s, null, rid in rows]
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], pa.int64()) for j in range(4)],
                                         ["anchor", "window", "score", "id"])

    return run


def _best(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)


def _mine_block(rows: DataFrame, block, positives: int, negatives: int, low: int) -> DataFrame | None:
    """Result rows of one block of anchors: (row, id, label, v) tuples, at most ``ANCHORS``."""
    spark = rows.sparkSession
    anchors = [(r["row"], r["id"], r["label"], np.array(r["v"], np.int64)) for r in block]
    sent = spark.sparkContext.broadcast(anchors)
    found = _best(rows.mapInArrow(_positives(sent, positives), "anchor long, score long, id long"), ["anchor"], positives)
    best: dict[int, list] = {}
    for r in found.collect():                 # at most ``positives`` rows an anchor of the block
        best.setdefault(r["anchor"], []).append((r["rank"], r["score"], r["id"]))
    # windows of equal scores are one window
    scores = {i: sorted({s for _, s, _ in rs if s >= 0}) for i, rs in best.items()}
    windows = [(a[2], a[3], [(-(-low * s // 100), s) for s in scores.get(i, [])]) for i, a in enumerate(anchors)]
    wanted = [(i, scores[i].index(s), rank, anchors[i][1], pid, s) for i, rs in best.items() for rank, s, pid in rs if s >= 0]
    if not wanted:
        return None
    sent2 = spark.sparkContext.broadcast(windows)
    near = _best(rows.mapInArrow(_negatives(sent2, negatives), "anchor long, window long, score long, id long"),
                 ["anchor", "window"], negatives)
    asked = spark.createDataFrame(wanted, "anchor long, window long, positive_rank int, anchor_id long, positive_id long, "
                                          "positive_score long")
    return (F.broadcast(asked).join(near, ["anchor", "window"])      # at most ANCHORS * positives rows
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score"), "positive_rank"))


def mine(df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", label: str = "label", every: int = 100,
         positives: int = 5, negatives: int = 5, low: int = 80, scale: int = 256, anchors: int = ANCHORS) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank).

    Anchors are the rows whose id ``every`` divides; ``low`` is the lower end of a window in percent.
    """
    spark = df.sparkSession
    rows = integer_rows(df, vector, id_col, label, scale)
    asked = rows.where(F.pmod(F.col("id"), F.lit(every)) == 0)
    asked = materialize(dense_index(asked, [F.asc("row")], name="place", start=0)
                        .withColumn("block", F.floor(F.col("place") / anchors)), "mining-anchors")
    blocks = -(-asked.count() // anchors)
    folder = shared_path(spark, "mining")
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, "
              "positive_rank int")
    spark.createDataFrame([], schema).write.parquet(f"{folder}/block=-1")
    for at in range(blocks):
        found = _mine_block(rows, asked.where(F.col("block") == at).orderBy("place").collect(), positives, negatives, low)
        if found is not None:
            found.write.mode("overwrite").parquet(f"{folder}/block={at}")
    return spark.read.schema(schema).parquet(f"{folder}/block=*").select(*[c.split()[0] for c in schema.split(", ")])
