"""Spelling variant grouping: words that differ by one edit, found by dense prefix-suffix tiling.

Words are counted over the whole corpus (partial and final aggregate).  Two words are near if one inserted, deleted
or replaced code point turns one into the other, which is so exactly if their common prefix and the common suffix
behind it together reach the longer length minus one.

Tiles.  For each length ``m`` of the longer word, the words of length ``m`` and ``m - 1`` are laid out in buckets.
With ``a`` first and ``b`` last code points known to agree, ``g = m - a - b`` are open; a single edit spares the first
or the last ``g // 2`` of them, so every near pair agrees in the next ``g // 2`` code points from one side.  A word
thus has two rows a length (four in all).  A bucket of more than ``TILE`` words is opened once more, its words
going to two smaller buckets each, until one code point is open: such a bucket holds no more words than the alphabet
has letters, so every bucket ends bounded and none is cut.  A pair that agrees on both sides is settled on the
prefix side: rows of a suffix bucket carry the prefix length (``cap``) from which on a pair is another bucket's.

Inside a task the words of a bucket are a padded matrix of code points; blocks of it are compared column by column
with all of the bucket, which gives the common prefix and suffix lengths of every pair of the tile.  No pair
leaves the task: a bucket returns one row a word with its number of near words and the best of them, and those add up
over buckets because each pair is met once.

Forms point to words with at least ``RATIO`` times the count, so chains are short; ``root`` follows them by pointer
doubling over written tables.

Defined cases: null and empty texts hold no words; a null id stands as the empty string in the draw; repeated rows
count as often as they stand; ties of ``n`` go to the word that is smaller in code-point order; an empty table gives
no rows; extra columns are not read.  Runs of any length are handled whole.
"""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions, text_or_empty

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
DRAW = 199
TILE = 512     # words of a bucket that are compared densely; larger ones are opened once more
_CELLS = 1 << 18  # cells of a tile held at a time


def word_counts(df: DataFrame, text: str = "text", id_col: str = "doc_id", least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT, draw: int = DRAW) -> DataFrame:
    """``(word, n)``: lower-cased letter runs, one code point deleted where ``draw`` divides the run's hash."""
    # shorter runs cannot give a word, so they are not even cut out
    runs = F.regexp_extract_all(text_or_empty(text), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    low = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    low = low.select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    h = low.select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    word = F.when(F.col("h") % draw == 0, cut).otherwise(F.col("run"))
    counts = h.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.col("n") >= least_count) & (F.char_length("word") >= least_length))


def _opened(rows: DataFrame) -> DataFrame:
    """Every row's two smaller buckets: the next ``g // 2`` code points from the front, or from the back."""
    g = F.col("m") - F.col("a") - F.col("b")
    h = (g / 2).cast("int")
    front = F.struct((F.col("a") + h).alias("a"), F.col("b").alias("b"), F.col("cap").alias("cap"))
    back = F.struct(F.col("a").alias("a"), (F.col("b") + h).alias("b"),
                    F.least("cap", F.col("a") + h).alias("cap"))
    out = rows.select("word", "n", "m", F.explode(F.array(front, back)).alias("t")).select("word", "n", "m", "t.*")
    # a bucket whose agreed prefix already reaches ``cap`` holds only pairs of other buckets
    out = out.where(F.col("a") < F.col("cap"))
    size = F.char_length("word")
    sides = F.concat(F.col("word").substr(F.lit(1), F.col("a")), F.lit("\u0000"),
                     F.col("word").substr(size - F.col("b") + 1, F.col("b")))
    return out.withColumn("key", F.xxhash64(sides))


BUCKET = ["m", "a", "b", "cap", "key"]


def tiles(words: DataFrame, tile: int = TILE) -> list[DataFrame]:
    """Written tables ``(word, n, m, a, b, cap, key)`` whose buckets together hold every near pair once.

    Each turn opens the buckets of more than ``tile`` words; at most log2 of the longest length turns.
    """
    size = F.char_length("word")
    start = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("m"))
    start = start.select("word", "n", "m", F.lit(0).alias("a"), F.lit(0).alias("b"), F.col("m").alias("cap"))
    out, rows = [], start
    while True:
        rows = materialize(_opened(rows), "spelling-tiles")
        # sizes are counted map-side combined; a bucket with one row, or without a word of length m, holds no pair
        sizes = rows.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("_size"), F.max(size).alias("_longest"))
        sizes = materialize(sizes.where((F.col("_size") > 1) & (F.col("_longest") == F.col("m"))), "spelling-sizes")
        deep = (F.col("_size") > tile) & (F.col("m") - F.col("a") - F.col("b") > 1)
        some = rows.join(sizes.where(~deep).select(*BUCKET), BUCKET)
        out.append(some)
        if not sizes.where(deep).limit(1).count():
            return out
        rows = rows.join(sizes.where(deep).select(*BUCKET), BUCKET).select("word", "n", "m", "a", "b", "cap")


def _agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(x rows by y rows) lengths of the common beginnings of zero-padded code points."""
    out = np.zeros((len(x), len(y)), np.int32)
    alive = np.ones((len(x), len(y)), bool)
    for c in range(x.shape[1]):
        alive &= (x[:, c, None] == y[None, :, c]) & (x[:, c, None] != 0)
        if not alive.any():
            break
        out += alive
    return out


def _matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words padded behind, padded in front, and their lengths."""
    size = np.array([len(w) for w in words], np.int64)
    m = int(size.max())
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    row = np.repeat(np.arange(len(words)), size)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    front, back = np.zeros((len(words), m), np.uint32), np.zeros((len(words), m), np.uint32)
    front[row, col] = flat
    back[row, col + np.repeat(m - size, size)] = flat
    return front, back, size


def near_in_tile(words: list[str], n: np.ndarray, m: int, a: int, b: int, cap: int):
    """Yield (place of a word, places of its near words in this bucket), the bucket's own pairs only."""
    front, back, size = _matrices(words)
    step = max(1, _CELLS // max(1, len(words)))
    for lo in range(0, len(words), step):
        block = slice(lo, min(lo + step, len(words)))
        prefix, suffix = _agree(front[block], front), _agree(back[block][:, ::-1], back[:, ::-1])
        longer = np.maximum(size[block][:, None], size[None, :])
        near = ((longer == m) & (np.minimum(prefix + suffix, longer) >= m - 1) & (prefix >= a) & (suffix >= b)
                & (prefix < cap))
        near[np.arange(near.shape[0]), np.arange(lo, lo + near.shape[0])] = False
        for x, y in _rows(near):
            yield lo + x, y


def _rows(hits: np.ndarray):
    at, other = np.nonzero(hits)
    cut = np.flatnonzero(np.diff(at)) + 1
    for places, others in zip(np.split(at, cut), np.split(other, cut)):
        if len(places):
            yield int(places[0]), others


def small_buckets(words: list[str], group: np.ndarray, m, a, b, cap):
    """Near pairs (x, y), both ways, of many small buckets at once: the ragged tile of their pairs, column by column.

    ``group`` numbers the buckets in ascending order; ``m``, ``a``, ``b``, ``cap`` hold for each word's bucket.
    """
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    count = np.diff(np.concatenate([starts, [len(group)]]))
    front, back, size = _matrices(words)
    # word i meets the words behind it in its bucket
    left = np.repeat(starts + count, count) - np.arange(len(group)) - 1
    x = np.repeat(np.arange(len(group)), left)
    y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(left) - left, left)
    longer = np.maximum(size[x], size[y])
    ok = (longer == m[x]) & (longer - np.minimum(size[x], size[y]) <= 1)
    x, y, longer = x[ok], y[ok], longer[ok]
    ends = []
    for codes in (front, back[:, ::-1]):
        agree, live = np.zeros(len(x), np.int64), np.arange(len(x))
        for c in range(codes.shape[1]):
            u, v = codes[x[live], c], codes[y[live], c]
            live = live[(u == v) & (u != 0)]
            if not len(live):
                break
            agree[live] += 1
        ends.append(agree)
    prefix, suffix = ends
    ok = (np.minimum(prefix + suffix, longer) >= longer - 1) & (prefix >= a[x]) & (suffix >= b[x]) & (prefix < cap[x])
    x, y = x[ok], y[ok]
    return np.concatenate([x, y]), np.concatenate([y, x])


_DENSE = 48            # buckets of so many words are compared as one dense tile
_PAIRS = 1 << 20       # pairs of small buckets held at a time
_CODES = 1 << 22       # code points (padded) of small buckets held at a time


def _bests(words: list[str], n: np.ndarray, x: np.ndarray, y: np.ndarray):
    """A batch (word, near, best_n, best) from the near pairs (x, y): how many, and the largest n, then smallest word."""
    import pyarrow as pa

    order = np.lexsort((-n[y], x))
    x, y = x[order], y[order]
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    count = np.diff(np.concatenate([first, [len(x)]]))
    top = np.repeat(n[y[first]], count) == n[y]
    best: dict[int, str] = {}
    for i, w in zip(x[top].tolist(), y[top].tolist()):
        word = words[w]
        if i not in best or word < best[i]:
            best[i] = word
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in x[first].tolist()], pa.string()), pa.array(count.astype(np.int64)),
         pa.array(n[y[first]].astype(np.int64)), pa.array(list(best.values()), pa.string())],
        ["word", "near", "best_n", "best"])


def _dense(key: tuple, words: list[str], n: np.ndarray):
    found = list(near_in_tile(words, n, *key[:4]))
    if found:
        yield _bests(words, n, np.repeat([x for x, _ in found], [len(y) for _, y in found]),
                     np.concatenate([y for _, y in found]))


def _ragged(buckets: list):
    words = [w for _, ws, _ in buckets for w in ws]
    n = np.concatenate([c for _, _, c in buckets])
    size = [len(ws) for _, ws, _ in buckets]
    m, a, b, cap = (np.repeat([k[i] for k, _, _ in buckets], size) for i in range(4))
    x, y = small_buckets(words, np.repeat(np.arange(len(buckets)), size), m, a, b, cap)
    if len(x):
        yield _bests(words, n, x, y)


def _tile_batches(batches):
    """(word, near, best_n, best) per word and bucket, from rows sorted by bucket."""
    open_key, open_words, open_n = None, [], []
    small, pairs, held, longest = [], 0, 0, 0

    def close():
        nonlocal pairs, held, longest
        if len(open_words) >= _DENSE:
            yield from _dense(open_key, list(open_words), np.concatenate(open_n))
        elif len(open_words) > 1:
            if small and (held + len(open_words)) * max(longest, open_key[0]) > _CODES:
                yield from flush()
            small.append((open_key, list(open_words), np.concatenate(open_n)))
            pairs += len(open_words) ** 2 // 2
            held, longest = held + len(open_words), max(longest, open_key[0])
            if pairs >= _PAIRS:
                yield from flush()
        open_words.clear()
        open_n.clear()

    def flush():
        nonlocal pairs, held, longest
        if small:
            yield from _ragged(small)
        small.clear()
        pairs = held = longest = 0

    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([b.column(c).to_numpy().astype(np.int64) for c in BUCKET], 1)
        words, n = b.column("word").to_pylist(), b.column("n").to_numpy()
        cut = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]])
        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
            key = tuple(keys[s].tolist())
            if key != open_key:
                yield from close()
                open_key = key
            open_words += words[s:e]
            open_n.append(n[s:e])
    yield from close()
    yield from flush()


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``(word, n_near, best, best_n)`` of every word that has near words."""
    n = shuffle_partitions(words.sparkSession)
    parts = [t.repartition(n, *BUCKET).sortWithinPartitions(*BUCKET).select(*BUCKET, "word", "n")
             .mapInArrow(_tile_batches, "word string, near long, best_n long, best string") for t in tiles(words, tile)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return (rows.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for the words that have a form: the last word of the chain ``word -> form -> ...``.

    Pointer doubling over written tables; a form has a larger count than its word, so no chain is a cycle.
    """
    at = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = materialize(at.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                               F.col("further").isNotNull().alias("moved")),
                          "spelling-roots")
        at = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            return at


def variants(df: DataFrame, text: str = "text", id_col: str = "doc_id", ratio: int = RATIO, tile: int = TILE,
             **counting) -> DataFrame:
    """One row a word: word, n, n_near, form, form_n, root."""
    words = materialize(word_counts(df, text, id_col, **counting), "spelling-words")
    near = materialize(near_words(words, tile), "spelling-near")
    known = words.join(near, "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    rows = materialize(known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                    F.when(is_form, F.col("best")).alias("form"),
                                    F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    root = roots(rows.where("form IS NOT NULL"))
    return rows.join(root, "word", "left").withColumn("root", F.coalesce("root", "word"))
