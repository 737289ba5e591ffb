"""Best-fit packing of tokenized documents into sequences by a grouping genetic algorithm on islands.

A document's ids (with the end id) are one piece; a longer one than ``capacity`` is cut into pieces of ``capacity``,
the first of which takes what is left over.  Full pieces are sequences of their own.  The others are dealt by a hash
into shards of about ``SHARD`` pieces, and each shard is packed by ``ISLANDS`` populations:

* A chromosome gives every piece its bin.  The first ones are best-fit packings of the pieces in falling order and in
  falling order of disturbed lengths.
* Crossover injects whole well-filled bins of one parent into the other, takes out the other's bins that hold a
  piece twice, and best-fits the displaced pieces.  Mutation empties the worst and a few random bins and best-fits
  their pieces.
* Fitness is the number of bins, then the mean squared fill.  A shard whose best chromosome meets the lower bound of
  its pieces (their sum, and those of more than half a bin) is finished.
* After each epoch every island's elite migrates to the next island of its shard (one small join); islands are rows
  of a written table, so each epoch is one job that a lost executor cannot undo.

The bins of the best chromosome that are full but for ``SLACK`` tokens are final.  The pieces of the others meet those
of other shards in another round over fewer shards, until one shard is left or a round no longer releases a third of
its pieces; so shards cost about one bin together, not one bin each.

Real output: ``sequences`` (sequence_id, ids, parts), the packed ids; ``read_back`` cuts the pieces out of them again.

Texts are tokenized whole.  A plain byte-level file is encoded from its rank table by tiktoken, to the ids that the
tokenizers library gives; the string of a special token in a text is that token, as it is for the library.

Defined cases: null and empty texts are the end id alone; repeated rows and null ids are documents of their own; equal
lengths are interchangeable and settled by seed, so reruns agree; an empty table gives no rows; extra columns are not
read.  The work of a shard is bounded by its pieces, whatever the table.
"""

from __future__ import annotations

import bisect
import os
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import fits
from .common import materialize, shared_path, shuffle_partitions, worker_memory

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
CAPACITY = 2048
SHARD = 2048        # pieces of a shard, on average
ISLANDS = 3
POPULATION = 4
EPOCHS = 3
GENERATIONS = 6     # of an island in an epoch
SLACK = 4           # a bin with so few free tokens is final at once
SEED = 12
_STEP = 500         # texts held as Python strings at a time


# ---- tokens ---------------------------------------------------------------------


def _byte_alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable bytes are themselves, the others follow from
    U+0100 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class PieceTokenizer:
    """Ids of whole texts by a tokenizers file.

    A file of plain byte-level BPE (no normaliser, the standard splitting, ids in merge order) is the same thing as a
    table of ranks; tiktoken then encodes whole texts from that table, several times as fast, to the same ids.  Any
    other file, and texts with the string of a special token, go through the tokenizers library.
    """

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json
        import re
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        size = max(self.tok.get_vocab().values(), default=0) + 1
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        # control characters that white-space classes of regex engines read differently go to the library too
        self.whole = re.compile("|".join([*map(re.escape, sorted(special)), "[\x1c-\x1f\x85]"])).search
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ranks = _ranks(spec, special)
        self.fast = None
        if self.ranks is not None:
            import tiktoken
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.tok.encode(t, add_special_tokens=False).ids if self.fast is None or self.whole(t) else self.fast(t),
                         self.kind) for t in texts]


def _ranks(spec: dict, special: set[str]) -> dict[bytes, int] | None:
    """The rank table of a plain byte-level BPE file, else None."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
             and not split.get("add_prefix_space") and spec.get("normalizer") is None and spec.get("truncation") is None
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                                "fuse_unk", "byte_fallback", "ignore_merges")))
    vocab = model["vocab"]
    pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model.get("merges", [])]
    if not plain or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    alphabet = _byte_alphabet()
    return {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if t not in special}


def _tokenizer(path: str, pattern: str) -> PieceTokenizer:
    kept = worker_memory()
    if ("pieces", path, pattern) not in kept:
        kept["pieces", path, pattern] = PieceTokenizer(path, pattern)
    return kept["pieces", path, pattern]


def pieces(df: DataFrame, text: str = "text", id_col: str = "doc_id", path: str | None = None, end_id: int = END_ID,
           capacity: int = CAPACITY, pattern: str | None = None) -> DataFrame:
    """Written once: row, id, piece, start, length, width, ids (binary, ``width`` bytes an id)."""
    import public_tokenizers

    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN

    def run(batches):
        import pyarrow as pa
        for b in batches:
            t = _tokenizer(path, pattern)
            for lo in range(0, b.num_rows, _STEP):
                some = b.slice(lo, _STEP)
                at, piece, start, length, raw = [], [], [], [], []
                for i, ids in enumerate(t.encode([x or "" for x in some.column(1).to_pylist()])):
                    ids = np.append(ids, np.array([end_id], ids.dtype))
                    ends = list(range(len(ids), 0, -capacity))[::-1]
                    for p, (a, z) in enumerate(zip([0, *ends[:-1]], ends)):
                        at.append(i)
                        piece.append(p)
                        start.append(a)
                        length.append(z - a)
                        raw.append(ids[a:z].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array([int(t.kind[-1])] * len(at), pa.int32()), pa.array(raw, pa.binary())],
                    ["id", "piece", "start", "length", "width", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    out = src.mapInArrow(run, f"id {kind}, piece int, start long, length long, width int, ids binary")
    folder = shared_path(df.sparkSession, "pack-pieces")
    out.select(F.monotonically_increasing_id().alias("row"), "*").write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


# ---- the genetic algorithm (numpy, one shard at a time) ----------------------------


def best_fit(size: np.ndarray, order: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """``bins`` with the pieces ``order`` (bin -1 so far) put one by one where the least room is left."""
    bins = bins.copy()
    placed = bins >= 0
    n = int(bins.max()) + 1 if placed.any() else 0
    free = capacity - np.bincount(bins[placed], size[placed], n).astype(np.int64) if n else np.empty(0, np.int64)
    # (room, bin) packed in one integer, sorted
    room = sorted((f << 32 | b) for b, f in enumerate(free.tolist()) if f)
    for i, s in zip(order.tolist(), size[order].tolist()):
        k = bisect.bisect_left(room, s << 32)
        if k < len(room):
            f = room.pop(k)
            b, f = f & 0xFFFFFFFF, f >> 32
        else:
            b, f, n = n, capacity, n + 1
        bins[i] = b
        if f > s:
            bisect.insort(room, (f - s) << 32 | b)
    return bins


def renumbered(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].reshape(-1).astype(np.int64)


def fitness(size: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """(bins, minus the mean squared fill): smaller is better."""
    fill = np.bincount(bins, size) / capacity
    return len(fill), -float((fill * fill).mean())


def lower_bound(size: np.ndarray, capacity: int) -> int:
    return max(-(-int(size.sum()) // capacity), int((2 * size > capacity).sum()))


def falling(size: np.ndarray, some: np.ndarray) -> np.ndarray:
    return some[np.argsort(-size[some], kind="stable")]


def crossover(size: np.ndarray, a: np.ndarray, b: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Well-filled bins of ``b`` go whole into ``a``; ``a``'s bins with a piece among theirs are dissolved."""
    fill = np.bincount(b, size)
    good = np.flatnonzero(fill >= np.median(fill))
    picked = np.zeros(len(fill), bool)
    picked[good[rng.random(len(good)) < 0.5]] = True
    injected = picked[b]
    broken = np.zeros(int(a.max()) + 1, bool)
    broken[a[injected]] = True
    child = np.where(broken[a], -1, a)
    child[injected] = len(broken) + b[injected]
    displaced = np.flatnonzero(child < 0)
    child[child >= 0] = renumbered(child[child >= 0])
    return best_fit(size, falling(size, displaced), child, capacity)


def mutate(size: np.ndarray, bins: np.ndarray, capacity: int, rng) -> np.ndarray:
    """The worst-filled bin and a few others are emptied; their pieces are best-fitted in disturbed falling order."""
    fill = np.bincount(bins, size)
    out = np.zeros(len(fill), bool)
    out[np.argsort(fill)[:1 + len(fill) // 50]] = True
    out[rng.integers(0, len(fill), 2 + len(fill) // 50)] = True
    child = np.where(out[bins], -1, bins)
    displaced = np.flatnonzero(child < 0)
    if (child >= 0).any():
        child[child >= 0] = renumbered(child[child >= 0])
    noise = size[displaced] * (1 + 0.2 * rng.random(len(displaced)))
    return best_fit(size, displaced[np.argsort(-noise, kind="stable")], child, capacity)


def seeded_population(size: np.ndarray, capacity: int, rng, plain: bool) -> list[np.ndarray]:
    empty = np.full(len(size), -1, np.int64)
    noise = [np.zeros(len(size))] if plain else []
    noise += [rng.random(len(size)) * (0.05 + 0.3 * k / POPULATION) for k in range(POPULATION - len(noise))]
    return [best_fit(size, np.argsort(-size * (1 + x), kind="stable"), empty, capacity) for x in noise]


def evolve(size: np.ndarray, population: list[np.ndarray], capacity: int, rng, generations: int = GENERATIONS) -> list[np.ndarray]:
    """The population after some generations, best first; stops as soon as the lower bound is met."""
    bound = lower_bound(size, capacity)
    held = sorted(((fitness(size, p, capacity), k, p) for k, p in enumerate(population)), key=lambda x: x[:2])
    number = len(held)
    for _ in range(generations):
        if held[0][0][0] <= bound:
            break
        i, j = sorted(rng.integers(0, len(held), 2).tolist()), sorted(rng.integers(0, len(held), 2).tolist())
        children = [crossover(size, held[i[0]][2], held[j[0]][2], capacity, rng), mutate(size, held[i[0]][2], capacity, rng)]
        for c in children:
            held.append((fitness(size, c, capacity), number, c))
            number += 1
        held = sorted(held, key=lambda x: x[:2])[:len(population)]
    return [p for _, _, p in held]


# ---- islands as rows ------------------------------------------------------------


_STATE = "shard long, island int, rows binary, sizes binary, population binary, n_bins long, fit double, done boolean"


def _islands(capacity: int, seed: str, generations: int):
    """mapInArrow over island rows: seed a population where there is none, take in the migrant, evolve."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            for r in range(b.num_rows):
                shard, island, rows, sizes, population, migrant = (b.column(c)[r].as_py() for c in (
                    "shard", "island", "rows", "sizes", "population", "migrant"))
                size = np.frombuffer(sizes, "<i8")
                rng = np.random.default_rng(zlib.crc32(f"{seed}:{shard}:{island}".encode()))
                if population is None:
                    held = seeded_population(size, capacity, rng, island == 0)
                else:
                    held = list(np.frombuffer(population, "<i4").astype(np.int64).reshape(-1, len(size)))
                    if migrant is not None:  # the neighbour's elite takes the place of the worst
                        held[-1] = np.frombuffer(migrant, "<i4").astype(np.int64)
                held = evolve(size, held, capacity, rng, generations)
                n, fit = fitness(size, held[0], capacity)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int64()), pa.array([island], pa.int32()), pa.array([rows], pa.binary()),
                     pa.array([sizes], pa.binary()), pa.array([np.stack(held).astype("<i4").tobytes()], pa.binary()),
                     pa.array([n], pa.int64()), pa.array([fit]), pa.array([n <= lower_bound(size, capacity)])],
                    ["shard", "island", "rows", "sizes", "population", "n_bins", "fit", "done"])

    return run


def _shard_rows(items: DataFrame, shards: int, seed: int, at_round: int) -> DataFrame:
    """One row a shard: its rows and lengths, in row order (about ``SHARD`` pieces, bounded by the hash)."""
    where = F.pmod(F.xxhash64("row", F.lit(f"{seed}-{at_round}")), F.lit(shards))
    per = (items.groupBy(where.alias("shard"))
           .agg(F.sort_array(F.collect_list(F.struct("row", "length"))).alias("t")))

    def pack(batches):
        import pyarrow as pa
        for b in batches:
            t = b.column(1)
            rows, sizes = [], []
            for x in t:
                rows.append(x.values.field("row").to_numpy().astype("<i8").tobytes())
                sizes.append(x.values.field("length").to_numpy().astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.binary()), pa.array(sizes, pa.binary())],
                                             ["shard", "rows", "sizes"])

    return per.mapInArrow(pack, "shard long, rows binary, sizes binary")


def evolved(shard_rows: DataFrame, capacity: int, seed: str, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """The best chromosome of every shard: shard, rows, sizes, bins (binary int32), n_bins."""
    n = shuffle_partitions(shard_rows.sparkSession)
    start = (shard_rows.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1)).cast("array<int>")))
             .withColumn("population", F.lit(None).cast("binary")).withColumn("migrant", F.lit(None).cast("binary")))
    states, at = [], start.repartition(n, "shard", "island")
    for epoch in range(epochs):
        state = materialize(at.mapInArrow(_islands(capacity, f"{seed}-{epoch}", GENERATIONS), _STATE), "pack-islands")
        over = state.groupBy("shard").agg(F.max("done").alias("over"))
        states.append((state, over))
        if epoch == epochs - 1:
            break
        # finished shards stop; in the others each island's elite moves on to the next island
        open_ = state.join(over.where("NOT over").select("shard"), "shard")
        bytes_of = F.length("sizes") / 2  # a chromosome has 4 bytes a piece, a length 8
        elite = open_.select("shard", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"),
                             F.substring("population", F.lit(1), bytes_of.cast("int")).alias("migrant"))
        at = open_.drop("n_bins", "fit", "done").join(elite, ["shard", "island"], "left")
    out = None
    for k, (state, over) in enumerate(states):
        kept = state.join(over.where("over").select("shard"), "shard") if k < len(states) - 1 else state
        out = kept if out is None else out.unionByName(kept)
    bins = F.substring("population", F.lit(1), (F.length("sizes") / 2).cast("int"))
    order = F.struct("n_bins", "fit", "island")
    best = out.groupBy("shard").agg(F.min_by(F.struct("rows", "sizes", bins.alias("bins"), "n_bins"), order).alias("b"))
    return materialize(best.select("shard", "b.*"), "pack-best")


def _settle(capacity: int, slack: int | None, base: int, width: int):
    """mapInArrow over best chromosomes: a row a piece; bins with more free room than ``slack`` stay open."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            for r in range(b.num_rows):
                shard, rows, sizes, bins = (b.column(c)[r].as_py() for c in ("shard", "rows", "sizes", "bins"))
                row, size = np.frombuffer(rows, "<i8"), np.frombuffer(sizes, "<i8")
                bins = np.frombuffer(bins, "<i4").astype(np.int64)
                fill = np.bincount(bins, size).astype(np.int64)
                is_open = np.zeros(len(fill), bool) if slack is None else fill < capacity - slack
                order = np.lexsort((row, bins))
                row, size, bins = row[order], size[order], bins[order]
                before = np.cumsum(size) - size
                first = np.concatenate([[True], bins[1:] != bins[:-1]])
                offset = before - np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(bins))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), pa.array(size), pa.array(base + shard * width + bins), pa.array(offset),
                     pa.array(is_open[bins])], ["row", "length", "sequence_id", "offset", "open"])

    return run


def place(items: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, slack: int = SLACK, seed: int = SEED) -> DataFrame:
    """``(row, sequence_id, offset)`` for ``items(row, length)``, written; lengths of 1 to ``capacity``."""
    items = items.select("row", "length")
    full = items.where(F.col("length") == capacity)
    out = full.select("row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left, base, turn = items.where(F.col("length") < capacity), 0, 0
    n = left.count()
    while n:
        shards = max(1, -(-n // shard))
        best = evolved(_shard_rows(left, shards, seed, turn), capacity, f"{seed}-{turn}")
        width = best.agg(F.max("n_bins")).first()[0]
        kind = "row long, length long, sequence_id long, offset long, open boolean"
        made = materialize(best.mapInArrow(_settle(capacity, slack, base, width), kind), "pack-settled")
        open_ = made.where("open")
        again = open_.count()
        if shards == 1 or 3 * again > 2 * n:  # nothing to gain from meeting other shards' pieces again
            out = out.unionByName(made.select("row", "sequence_id", "offset"))
            break
        out = out.unionByName(made.where("NOT open").select("row", "sequence_id", "offset"))
        left, base, turn, n = open_.select("row", "length"), base + shards * width, turn + 1, again
    return materialize(out, "pack-placed")


def sequences(pieces_: DataFrame, placed: DataFrame) -> DataFrame:
    """sequence_id, width, ids (the packed ids), parts (id, piece, start, length, offset, in order).

    The ids move once, to their sequences: the narrow placements are broadcast to them if they are measured to be
    small, and joined by a shuffle otherwise.
    """
    both = pieces_.join(F.broadcast(placed) if fits(placed) else placed, "row")
    part = F.struct("offset", "id", "piece", "start", "length", "ids")
    got = both.groupBy("sequence_id").agg(F.max("width").alias("width"), F.sort_array(F.collect_list(part)).alias("p"))
    ids = F.aggregate(F.transform("p", lambda x: x["ids"]), F.lit(b""), lambda a, x: F.concat(a, x))
    parts = F.transform("p", lambda x: F.struct(*[x[c].alias(c) for c in ("id", "piece", "start", "length", "offset")]))
    return got.select("sequence_id", "width", ids.alias("ids"), parts.alias("parts"))


def read_back(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row a piece, cut out of the packed ids again: id, piece, start, length, ids_crc32, sequence_id, offset."""
    parts = packed.select("sequence_id", "width", "ids", F.explode("parts").alias("p"))
    own = F.substring("ids", F.col("p.offset").cast("int") * F.col("width") + 1, F.col("p.length").cast("int") * F.col("width"))
    src = parts.select(F.col("p.id").alias("id"), "p.piece", "p.start", "p.length", "sequence_id", "p.offset", "width", own.alias("ids"))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            crc = [zlib.crc32(np.frombuffer(x, f"<u{w}").astype("<u4").tobytes())
                   for x, w in zip(b.column("ids").to_pylist(), b.column("width").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("id", "piece", "start", "length")), pa.array(crc, pa.int64()),
                 b.column("sequence_id"), b.column("offset")],
                ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)


def pack(df: DataFrame, text: str = "text", id_col: str = "doc_id", path: str | None = None, end_id: int = END_ID,
         capacity: int = CAPACITY, shard: int = SHARD, slack: int = SLACK, seed: int = SEED) -> DataFrame:
    """The packed sequences of a table's documents (see ``sequences``)."""
    cut = pieces(df, text, id_col, path, end_id, capacity)
    return sequences(cut, place(cut, capacity, shard, slack, seed))


def pack_round_trip(df: DataFrame, text: str = "text", id_col: str = "doc_id", **how) -> DataFrame:
    return read_back(pack(df, text, id_col, **how), id_col)
