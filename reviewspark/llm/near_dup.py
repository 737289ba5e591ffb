"""MinHash near-dedup with fast similarity sketching.

Sketch.  A set is thrown into ``t`` bins in rounds.  In round i < t every element lands in a random bin with
value (i, random); in round t + j every element lands in bin j.  A bin keeps its smallest value; a set stops
once every bin is full, and by round 2t - 1 every bin surely is.  Two sets agree in a bin with probability
close to their Jaccard similarity, with the concentration of t samples, in O(t log t + n) time.

Banding.  ``ROWS`` bins make a band key, ``BANDS`` keys a document: at similarity 0.75 a pair shares no band
with probability (1 - 0.75^5)^40 = 2e-5.  Rows of equal shingle sets are first reduced to one representative.

Links.  Buckets (rows of one band key) are never paired up.
 1. A bucket's hub is its member that meets most others over all bands (the original among its edited copies).
    Each representative proposes to the hub it shares most bands with: one pair per representative, verified
    on the full sets, then connected components.
 2. A bucket whose members are all in one component needs nothing more.  In the others members are dealt into
    blocks of ``BLOCK`` rows, and pairs of blocks are compared on 8-bit sketches inside tasks.  Each row
    proposes to the row of another component that it resembles most: again one pair a row, then components.
 3. In the buckets that are still open every pair *across* components is settled: pairs whose estimate reaches
    ``ESTIMATE`` (4.6 standard deviations of an 800-bin estimate under the threshold) are verified exactly, each in the first band
    that it shares.  No bucket or candidate is capped.
 4. Components of all verified links give the result.

Verification recomputes both full shingle sets from the texts; 100 * intersection >= 75 * union decides.

Null and empty texts have an empty set and are linked with nothing.  Rows may repeat and ids may be null or
tie: rows are numbered internally; a component's id is its smallest id, nulls last.  Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window  # noqa: F401
from pyspark.sql import functions as F

from ..operators.joins import fits
from .common import forget, fresh, materialize, shuffle_partitions, text_or_empty
from .exact_dedup import RepeatFilter
from .shingles import mix, shingle_sets

ROWS, BANDS = 5, 40
BINS = 800           # of a sketch; the first ROWS * BANDS make the bands, all of them the estimate
SHINGLE = 5
PERCENT = 75
ESTIMATE = 0.68
BLOCK = 512
PARTNERS = 64        # of one row that are verified beside one copy of its text

_U = np.uint64
_SEEDS = mix(np.arange(1, 2 * BINS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def sketches(s: np.ndarray, at: np.ndarray, bins: int = BINS) -> np.ndarray:
    """(documents x bins) smallest values; rows of empty sets stay at the maximum."""
    docs = len(at) - 1
    size = np.diff(at)
    top = np.iinfo(np.uint64).max
    out = np.full(docs * bins, top, np.uint64)
    doc = np.repeat(np.arange(docs), size)
    elems, r = s, 0
    while r < 2 * bins and len(elems):
        # few elements left: several rounds at once (a later round's value never replaces an earlier one's)
        step = min(max(1, 100_000 // len(elems)), (bins if r < bins else 2 * bins) - r)
        rounds = np.arange(r, r + step)
        h = mix(elems[:, None] ^ _SEEDS[rounds][None, :])
        value = (rounds.astype(np.uint64) << _U(52))[None, :] | (h >> _U(12))
        if r < bins:
            bin_ = ((h & _U(0xFFFFFFFF)) * _U(bins) >> _U(32)).astype(np.int64)
        else:
            bin_ = np.broadcast_to(rounds - bins, h.shape)
        np.minimum.at(out, (doc[:, None] * bins + bin_).ravel(), value.ravel())
        r += step
        open_ = (out.reshape(docs, bins) == top).any(1)
        left = open_[doc]
        elems, doc = elems[left], doc[left]
    return out.reshape(docs, bins)


def band_keys(sk: np.ndarray, rows: int = ROWS) -> np.ndarray:
    docs, bins = len(sk), ROWS * BANDS
    parts = sk[:, :bins].reshape(docs, bins // rows, rows)
    key = np.broadcast_to(mix(np.arange(1, bins // rows + 1, dtype=np.uint64)), (docs, bins // rows)).copy()
    for j in range(rows):
        key = mix(key * _U(0xD6E8FEB86659FD93) + parts[:, :, j])
    return key


def _sketch_batches(batches):
    import pyarrow as pa
    forget("powers")
    for b in batches:
        n, h1, h2, keys, sig = [], [], [], [], []
        for _, s, at in shingle_sets(b.column(1), SHINGLE):
            size = np.diff(at)
            n.append(size)
            full = np.flatnonzero(size)
            for h, salt in ((h1, 1), (h2, 2)):
                v = np.zeros(len(size), np.uint64)
                if len(full):
                    v[full] = np.add.reduceat(mix(s * _U(2 * salt + 1) + _U(salt)), at[:-1][full])
                h.append(v)
            sk = sketches(s, at)
            keys.append(band_keys(sk))
            sig.append(mix(sk).astype(np.uint8))
        if not n:
            continue
        n = np.concatenate(n)
        keys = np.concatenate(keys).astype(np.int64).ravel()
        some = np.repeat(n > 0, BANDS)
        offs = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
        sig = np.concatenate(sig)
        yield pa.RecordBatch.from_arrays([
            b.column(0), b.column(2), pa.array(n.astype(np.int64)),
            pa.array(np.concatenate(h1).astype(np.int64)), pa.array(np.concatenate(h2).astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(offs), pa.array(keys[some])),
            pa.array([x.tobytes() for x in sig], pa.binary())],
            ["id", "th", "n", "h1", "h2", "bands", "sig"])


def sketch_table(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """Written once: row, id, th (hash of the text), n, h1, h2 (identify the set), bands, sig (8-bit sketch)."""
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("id"), text_or_empty(text).alias("text"),
                    F.xxhash64(text_or_empty(text)).alias("th"))
    out = src.mapInArrow(_sketch_batches, f"id {kind}, th long, n long, h1 long, h2 long, bands array<long>, sig binary")
    return materialize(out.select(F.monotonically_increasing_id().alias("row"), "*"), "near-sketch")


def _verify_batches(batches):
    """(u, v) of the rows (v, block, u, text), sorted so that v's own text (u is null) comes before its partners'."""
    import pyarrow as pa

    forget("powers")
    hub = np.empty(0, np.uint64)  # the one set that is held: v's
    for b in batches:
        v, partner = b.column("v").to_numpy(), b.column("u")
        own = ~np.asarray(partner.is_valid())
        u = partner.fill_null(0).to_numpy()
        ok = np.zeros(b.num_rows, bool)
        for first, s, at in shingle_sets(b.column("text"), SHINGLE):
            for i in range(len(at) - 1):
                x = s[at[i]:at[i + 1]]
                if own[first + i]:
                    hub = x.copy()
                elif len(x) and len(hub) and 100 * min(len(x), len(hub)) >= PERCENT * max(len(x), len(hub)):
                    both = np.sort(np.concatenate([x, hub]))
                    common = int((both[1:] == both[:-1]).sum())
                    ok[first + i] = 100 * common >= PERCENT * (len(x) + len(hub) - common)
        yield pa.RecordBatch.from_arrays([pa.array(u[ok]), pa.array(v[ok])], ["u", "v"])


def _sent(narrow: DataFrame) -> DataFrame:
    """A written narrow table, broadcast if it is measured to be small, so that the texts it is joined with do not move."""
    return F.broadcast(narrow) if fits(narrow) else narrow


def verified(pairs: DataFrame, sketch: DataFrame, df: DataFrame, text: str, id_col: str) -> DataFrame:
    """The pairs (u, v) whose full shingle sets are similar enough.

    Texts of the rows in question are fetched once: a Bloom filter of their ids marks the candidates where
    they lie, so texts that no pair needs are not shuffled.  A row v with many partners is dealt into blocks of
    about ``PARTNERS`` of them, each of which gets v's text once; a task holds v's set and reads the partners past it.
    """
    n = shuffle_partitions(df.sparkSession)
    pairs = materialize(pairs, "near-pairs")
    wanted = pairs.select(F.col("u").alias("row")).union(pairs.select("v")).distinct()
    wanted = materialize(wanted.join(sketch.select("row", "id", "th"), "row"), "near-wanted")
    keyed = wanted.withColumn("key", F.xxhash64("id", "th"))
    flt = RepeatFilter.build(keyed, "key", max(1, wanted.count()), least=1)
    docs = df.select(F.col(id_col).alias("id"), text_or_empty(text).alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    docs = flt.mark(docs, F.xxhash64("id", "th"), "maybe").where("maybe")
    w = _sent(wanted.withColumnsRenamed({"id": "wid", "th": "wth"}))
    texts = docs.join(w, (docs["th"] == w["wth"]) & docs["id"].eqNullSafe(w["wid"])).select("row", "text")
    texts = materialize(texts, "near-texts")
    blocks = pairs.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("blocks"))
    blocks = materialize(blocks, "near-blocks")
    hubs = materialize(blocks.select(F.col("v").alias("row"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")), "near-hub-blocks")
    hubs = (texts.join(_sent(hubs), "row").select(F.col("row").alias("v"), "block", F.lit(None).cast("long").alias("u"), "text"))
    partners = pairs.join(_sent(blocks), "v").select("v", F.pmod(F.xxhash64("u"), F.col("blocks")).cast("int").alias("block"), "u")
    partners = materialize(partners, "near-partners")
    partners = texts.withColumnRenamed("row", "u").join(_sent(partners), "u").select("v", "block", "u", "text")
    dealt = (hubs.unionByName(partners).repartition(n, "v", "block")
             .sortWithinPartitions("v", "block", F.asc_nulls_first("u")))
    return materialize(dealt.select("v", "u", "text").mapInArrow(_verify_batches, "u long, v long"), "near-links")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (u, v): comp is the smallest node it is connected with.

    Each turn takes the smallest label among neighbours and then follows labels of labels; all state is in
    written tables, nothing is collected but one count a turn.
    """
    both = materialize(links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(),
                       "cc-edges")
    label = materialize(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("u"), F.min("v")).alias("comp")),
                        "cc-label")
    while True:
        near = (both.join(label, both["v"] == label["node"]).groupBy("u").agg(F.min("comp").alias("near"))
                .withColumnRenamed("u", "node"))
        down = label.join(near, "node").select("node", F.col("comp").alias("old"),
                                               F.least("comp", "near").alias("comp"))
        up = label.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        new = materialize(down.join(up, "comp", "left").select(
            "node", "old", F.least("comp", F.coalesce("further", "comp")).alias("comp")), "cc-label")
        changed = new.where("old <> comp").limit(1).count()
        label = new.select("node", "comp")
        if not changed:
            return label


def _cross(key: int, rows: list[np.ndarray], best: bool):
    """Yield (u, v, estimate) across the components of one pair of blocks, by their sketches.

    A pair is settled in the bucket of the first band it shares; with ``best`` a row proposes one partner only.
    """
    side, comp, row, n, sig, bands = rows
    a = np.flatnonzero(side != 1)
    b = np.flatnonzero(side != 0)  # side 2: both blocks are the same
    if best:
        a = np.arange(len(row))
    for x in a:
        other = b if not best or side[x] == 2 else np.flatnonzero(side != side[x])
        y = other[(comp[other] != comp[x]) & (100 * np.minimum(n[other], n[x]) >= PERCENT * np.maximum(n[other], n[x]))]
        if not best and side[x] == 2:
            y = y[row[y] > row[x]]
        if not len(y):
            continue
        same = ((sig[y] == sig[x]).mean(1) - 1 / 256) / (1 - 1 / 256)
        near = same >= ESTIMATE
        y, same = y[near], same[near]
        if not len(y):
            continue
        if best:
            k = np.lexsort((row[y], -same))[0]
            yield row[x], row[y[k]], same[k]
            continue
        shared = bands[y] == bands[x]
        first = bands[x][shared.argmax(1)] == key
        for z, e in zip(y[first], same[first]):
            yield min(row[x], row[z]), max(row[x], row[z]), e


def _cross_batches(best: bool):
    def run(batches):
        import pyarrow as pa

        kinds = (pa.int64(), pa.int64(), pa.float64())
        batch = lambda out: pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in out], kinds[k]) for k in range(3)], ["u", "v", "e"])
        held, held_key, out = [], None, []

        def flush():
            out.extend(_cross(held_key[0], [np.concatenate(p) for p in zip(*held)], best))
            held.clear()

        for b in batches:
            if not b.num_rows:
                continue
            key = np.stack([b.column(c).to_numpy() for c in ("key", "i", "j")], 1)
            cols = [b.column(c).to_numpy() for c in ("side", "comp", "row", "n")]
            cols.append(np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint8).reshape(b.num_rows, -1))
            cols.append(b.column("bands").flatten().to_numpy().reshape(b.num_rows, -1))
            cut = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [len(key)]])
            for s, e in zip(cut[:-1], cut[1:]):
                this = tuple(key[s])
                if this != held_key and held:
                    flush()
                held_key = this
                held.append([c[s:e] for c in cols])
            if len(out) > 50_000:
                yield batch(out)
                out.clear()
        if held:
            flush()
        yield batch(out)

    return run


def cross_pairs(buckets: DataFrame, label: DataFrame, sketch: DataFrame, best: bool = False,
                block: int = BLOCK) -> DataFrame:
    """Candidate pairs (u, v) across components within buckets, by estimate; with ``best`` one for each row u."""
    spark = buckets.sparkSession
    lab = buckets.join(label.withColumnRenamed("node", "row"), "row", "left")
    lab = materialize(lab.select("key", "row", F.coalesce("comp", "row").alias("comp")), "near-open")
    open_ = (lab.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"))
             .where("lo <> hi").select("key", F.ceil(F.col("m") / block).cast("int").alias("blocks")))
    rows = lab.join(open_, "key").join(sketch.select("row", "n", "sig", "bands"), "row")
    rows = rows.withColumn("at", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"),
                       F.when(F.col("at") == F.col("other"), 2).when(F.col("at") < F.col("other"), 0).otherwise(1)
                       .alias("side"), "comp", "row", "n", "sig", "bands")
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))
    dealt = rows.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = dealt.mapInArrow(_cross_batches(best), "u long, v long, e double")
    if not best:
        return found.select("u", "v")
    return found.groupBy("u").agg(F.max_by("v", F.struct("e", "v")).alias("v"))


def near_classes(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: row, id, th, n_shingles, comp (internal number of its component)."""
    sketch = sketch_table(df, text, id_col)
    same = ["n", "h1", "h2"]
    classes = materialize(sketch.where("n > 0").groupBy(*same).agg(F.min("row").alias("rep"),
                                                                   F.count(F.lit(1)).alias("size")), "near-classes")
    reps = sketch.join(classes.select(F.col("rep").alias("row")), "row", "left_semi")
    keys = reps.select("row", F.explode("bands").alias("key"))
    sizes = materialize(keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "near-bucket-sizes")
    members = materialize(keys.join(sizes, "key"), "near-members")
    met = members.groupBy("row").agg(F.sum("m").alias("met"))
    ranked = members.select("key", "row").join(met, "row")
    hubs = materialize(ranked.groupBy("key").agg(F.max(F.struct("met", F.xxhash64("row").alias("o"), F.col("row").alias("hub")))
                                                 .alias("h")).select("key", "h.hub"), "near-hubs")
    buckets = materialize(members.select("key", "row").join(hubs, "key"), "near-buckets")
    shared = buckets.where("row <> hub").groupBy("row", "hub").agg(F.count(F.lit(1)).alias("c"))
    best = shared.groupBy("row").agg(F.max(F.struct("c", F.xxhash64("hub").alias("o"), "hub")).alias("b"))
    links = verified(best.select(F.col("row").alias("u"), F.col("b.hub").alias("v")), sketch, df, text, id_col)
    for best in (True, False):
        found = cross_pairs(buckets.select("key", "row"), components(links), sketch, best)
        links = materialize(links.unionByName(verified(found, sketch, df, text, id_col)), "near-links")
    label = components(links)
    of = classes.join(label.select(F.col("node").alias("rep"), "comp"), "rep", "left").select(
        *same, F.coalesce("comp", "rep").alias("comp"))
    rows = sketch.select("row", "id", "th", *same)
    some = rows.where("n > 0").join(of, same).select("row", "id", "th", F.col("n").alias("n_shingles"), "comp")
    none = rows.where("n = 0").select("row", "id", "th", F.col("n").alias("n_shingles"), F.col("row").alias("comp"))
    return materialize(some.unionByName(none), "near-rows")


def near_dedup(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: id, n_shingles, component_id, kept."""
    rows = near_classes(df, text, id_col)
    # written, so that the join deals both sides anew and AQE can split a large component
    least = materialize(rows.groupBy("comp").agg(F.min("id").alias("component_id")), "near-least")
    out = rows.join(least, "comp")
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``df`` with one row of each component (the smallest id; nulls last), same columns.

    The rows to drop go through a Bloom filter, so rows that surely stay are not moved.
    """
    rows = near_classes(df, text, id_col)
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))
    first = rows.groupBy("comp").agg(F.min_by("row", order).alias("stays"), F.count(F.lit(1)).alias("size"))
    groups = rows.join(materialize(first.where("size > 1").select("comp", "stays"), "near-first"), "comp")
    moved = materialize(groups.select("id", "th", (F.col("row") == F.col("stays")).alias("stays"),
                                      F.xxhash64("id", "th").alias("key")), "near-moved")
    flt = RepeatFilter.build(moved, "key", max(1, moved.count()), least=1)
    cols = df.columns
    th, maybe, size = fresh(df, "th"), fresh(df, "maybe"), fresh(df, "copies")
    marked = flt.mark(df.withColumn(th, F.xxhash64(text_or_empty(text))), F.xxhash64(F.col(id_col), F.col(th)), maybe)
    alone = marked.where(~F.col(maybe)).select(*[F.col(f"`{c}`") for c in cols])
    some = marked.where(F.col(maybe)).drop(maybe)
    # rows equal in id and text are one row here: either all were copies of another row, or one of them stays
    fate = moved.groupBy(F.col("id").alias("_fid"), F.col("th").alias("_fth")).agg(F.max("stays").alias(size))
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    joined = some.join(fate, (some[th] == fate["_fth"]) & some[id_col].eqNullSafe(fate["_fid"]), "left")
    free = joined.where(F.col(size).isNull()).select(*[some[f"`{c}`"] for c in cols])
    stay = joined.where(F.col(size)).select(*[some[f"`{c}`"] for c in cols], some[th])
    one = stay.groupBy(F.col(id_col), F.col(th)).agg(F.min_by(row, F.xxhash64(*[F.col(f"`{c}`") for c in cols])).alias("row"))
    return alone.unionByName(free).unionByName(one.select("row.*"))
