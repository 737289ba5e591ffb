"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Training uses a documented, bounded sample of labelled rows (``SAMPLE``, smallest md5 of the id first) whose
``crc32(id) mod 5`` is not 0, in three disjoint parts:
 A. the lexicon: words and word beginnings (3 to 8 bytes) that toxic documents hold far more often, by
    document frequency per class, at most ``LEXICON`` entries;
 B. the trees: logistic loss, histogram splits, numpy on a (rows x features) matrix bounded by the sample;
 C. the calibration: isotonic regression (pool adjacent violators) of label on margin.
Scoring is row-local over every whole text; the model (a few thousand numbers) travels with the tasks.

Features: densities, counts, sums and maxima of lexicon weights; share of lexicon words within five words of
a second-person pronoun; capitals, all-caps words; exclamation and question marks and repeated punctuation;
rates of digit-for-letter spelling, symbols inside words and stretched letters.  Words are compared after
undoing common digit-for-letter spelling.  Labels, language, source and id are no inputs.

Null and empty texts have zero features and get the model's score for them.  Without labelled rows of both
classes the score is the training share of label 1 (0 when there are none).  Null ids are never held out.
Repeated label rows count as often as they stand; labels other than 0 and 1 are not used.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, smallest, text_or_empty
from .shingles import _C, _CHUNK, _P, _PINV, _powers, mix, string_buffers  # noqa: F401

SAMPLE = 12_000
LEXICON = 4096
LEAST_DOCS = 3
TREES, DEPTH, RATE, BINS, LEAF = 80, 3, 0.2, 32, 5.0
PREFIXES = (3, 4, 5, 6, 7, 8)
NEAR = 5

_U = np.uint64
# fixed values: second-person pronouns of the corpus languages
SECOND_PERSON = ("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
                 "tu", "te", "toi", "ton", "ta", "vous", "votre", "vos", "usted", "ustedes", "ti", "tus")
# fixed values: digits and symbols that stand for letters
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

_WORDY = np.zeros(256, bool)
_WORDY[[*range(48, 58), *range(65, 91), *range(97, 123), ord("@"), ord("$"), ord("*")]] = True
_WORDY[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord("@"), ord("$"), ord("*")]] = True


def _table() -> np.ndarray:
    t = mix(np.arange(1001, 1257, dtype=np.uint64) * _P)
    t[65:91] = t[97:123]
    for a, b in LEET.items():
        t[ord(a)] = t[ord(b)]
    return t


_BYTE = _table()


@dataclass
class Words:
    """Words of a run of documents: place, document and hashes."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    total: np.ndarray
    inverse: np.ndarray

    def whole(self) -> np.ndarray:
        return self._hash(self.end, 0)

    def prefix(self, k: int) -> np.ndarray:
        """Hash of the first ``k`` bytes; words no longer than that have the value of none (0)."""
        end = np.minimum(self.start + k, self.end)
        return np.where(self.end - self.start > k, self._hash(end, k), _U(0))

    def _hash(self, end, salt) -> np.ndarray:
        h = (self.total[end] - self.total[self.start]) * self.inverse[self.start]
        return mix(h ^ _U(salt * 0x51ED2701 + 1))


def words_of(data: np.ndarray, offs: np.ndarray) -> Words:
    n = len(data)
    p, inv = _powers(n + 1)
    wordy = _WORDY[data]
    gap = np.ones(n + 1, bool)
    if n:
        gap[1:n] = ~wordy[:-1] | ~wordy[1:]
        gap[offs] = True
    start = np.flatnonzero(wordy & gap[:-1])
    end = np.flatnonzero(wordy & gap[1:]) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * p[:n], out=total[1:])
    return Words(start, end, np.searchsorted(offs, start, "right") - 1, total, inv)


def _hash_word(w: str) -> int:
    data = np.frombuffer(w.encode(), np.uint8)
    with np.errstate(over="ignore"):
        return int(words_of(data, np.array([0, len(data)])).whole()[0])


def runs(arr):
    """(first row, bytes, offsets) for runs of rows of about a megabyte; a longer text is a run of its own."""
    data, offs = string_buffers(arr)
    i, n = 0, len(offs) - 1
    while i < n:
        j = min(n, max(int(np.searchsorted(offs, offs[i] + _CHUNK, "right")) - 1, i + 1))
        yield i, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def terms(data, offs) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, term) pairs: whole words and prefixes."""
    w = words_of(data, offs)
    doc = np.concatenate([w.doc] * (1 + len(PREFIXES)))
    term = np.concatenate([w.whole(), *(w.prefix(k) for k in PREFIXES)])
    doc, term = doc[term != 0], term[term != 0]
    order = np.lexsort((term, doc))
    doc, term = doc[order], term[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    return doc[new], term[new]


class Lexicon:
    def __init__(self, term: np.ndarray, weight: np.ndarray):
        order = np.argsort(term)
        self.term, self.weight = term[order], weight[order]
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.term >> _U(48)).astype(np.int64)] = True
        self.second = np.sort(np.array([_hash_word(x) for x in SECOND_PERSON], np.uint64))
        self.maybe2 = np.zeros(1 << 16, bool)
        self.maybe2[(self.second >> _U(48)).astype(np.int64)] = True

    @staticmethod
    def _find(table, maybe, h):
        """(places in h, places in table) of the members."""
        at = np.flatnonzero(maybe[(h >> _U(48)).astype(np.int64)])
        if not len(at) or not len(table):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(table, h[at]), len(table) - 1)
        ok = table[k] == h[at]
        return at[ok], k[ok]

    def weights(self, h) -> np.ndarray:
        out = np.zeros(len(h))
        at, k = self._find(self.term, self.maybe, h)
        out[at] = self.weight[k]
        return out

    def is_second(self, h) -> np.ndarray:
        return self._find(self.second, self.maybe2, h)[0]


FEATURES = ("log_words", "word_hits", "word_density", "word_sum", "word_max", "begin_hits", "begin_density", "begin_sum",
            "begin_max", "weight_density", "second_density", "hits_near_second", "share_near_second", "capitals",
            "caps_words", "exclaim", "question", "repeated_marks", "leet_words", "sign_words", "stretched",
            "leet_hits")


def features(data: np.ndarray, offs: np.ndarray, lex: Lexicon) -> np.ndarray:
    docs, n = len(offs) - 1, len(data)
    w = words_of(data, offs)
    per = lambda x, at=None: np.bincount(w.doc if at is None else w.doc[at], weights=x, minlength=docs)[:docs]
    top = lambda x: _max_by(w.doc, x, docs)
    nw = np.maximum(per(np.ones(len(w.doc))), 1.0)
    whole = w.whole()
    word = lex.weights(whole)
    begin = np.zeros(len(word))
    for k in PREFIXES:
        np.maximum(begin, lex.weights(w.prefix(k)), out=begin)
    best = np.maximum(word, begin)
    hits = np.flatnonzero(best > 0)
    second = lex.is_second(whole)
    near = np.zeros(len(hits))
    if len(hits) and len(second):
        k = np.searchsorted(second, hits)
        for j in (np.clip(k - 1, 0, len(second) - 1), np.clip(k, 0, len(second) - 1)):
            near = np.maximum(near, (np.abs(second[j] - hits) <= NEAR) & (w.doc[second[j]] == w.doc[hits]))
    nb = np.maximum(np.diff(offs), 1).astype(float)
    cum = lambda m: np.diff(np.concatenate([[0], np.cumsum(m)])[offs]).astype(float)
    inside = lambda m: (lambda c: c[w.end] - c[w.start])(np.concatenate([[0], np.cumsum(m)]))
    upper, letters = _UPPER[data], _UPPER[data] | _LOWER[data] | (data >= 128)
    length = w.end - w.start
    n_letters, n_digits, n_signs, n_upper = inside(letters), inside(_DIGIT[data]), inside(_SIGN[data]), inside(upper)
    leet = (n_letters > 0) & (n_digits > 0) & (n_digits < n_letters)
    mark = (data == 33) | (data == 63)
    twice = np.zeros(n, bool)
    triple = np.zeros(n, bool)
    if n > 1:
        twice[1:] = mark[1:] & mark[:-1]
    if n > 2:
        triple[2:] = letters[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (data[2:] < 128)
    whits, bhits, hcount = per((word > 0) * 1.0), per((begin > 0) * 1.0), per(np.ones(len(hits)), hits)
    nearby = per(near, hits)
    return np.column_stack([
        np.log(nw), whits, whits / nw, per(word), top(word), bhits, bhits / nw, per(begin), top(begin), per(best) / nw,
        per(np.ones(len(second)), second) / nw, nearby, nearby / np.maximum(hcount, 1.0),
        cum(upper) / nb, per(((n_upper == length) & (length > 1)) * 1.0) / nw,
        cum(data == 33) / nb, cum(data == 63) / nb, cum(twice) / nb,
        per(leet * 1.0) / nw, per(((n_letters > 0) & (n_signs > 0)) * 1.0) / nw, cum(triple) / nb,
        per((leet & (best > 0)) * 1.0)])


def _max_by(doc, x, docs):
    out = np.zeros(docs)
    if len(doc):
        cut = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        out[doc[cut]] = np.maximum.reduceat(x, cut)
    return out


class Trees:
    """Histogram gradient boosting for logistic loss: complete trees of one depth."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rate = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base = float(np.log(rate / (1 - rate)))
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
        margin = np.full(len(y), self.base)
        self.feature, self.cut, self.value = [], [], []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, np.maximum(p * (1 - p), 1e-9)
            node = np.zeros(len(y), np.int64)
            feature, cut = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, np.inf)
            for level in range(DEPTH):
                for k in range(2 ** level):
                    rows = np.flatnonzero(node == k)
                    f, b = self._split(binned[rows], g[rows], h[rows])
                    at = 2 ** level - 1 + k
                    if f >= 0:
                        feature[at], cut[at] = f, edges[f][b]
                for_nodes = 2 ** level - 1 + node
                node = 2 * node + (x[np.arange(len(y)), feature[for_nodes]] > cut[for_nodes])
            gs, hs = (np.bincount(node, weights=v, minlength=2 ** DEPTH) for v in (g, h))
            value = RATE * gs / (hs + 1.0)
            margin += value[node]
            self.feature.append(feature)
            self.cut.append(cut)
            self.value.append(value)

    @staticmethod
    def _split(binned, g, h):
        best, at = 1e-6, (-1, 0)
        total_g, total_h = g.sum(), h.sum()
        for f in range(binned.shape[1]):
            gs = np.cumsum(np.bincount(binned[:, f], weights=g, minlength=BINS))[:-1]
            hs = np.cumsum(np.bincount(binned[:, f], weights=h, minlength=BINS))[:-1]
            n = np.cumsum(np.bincount(binned[:, f], minlength=BINS))[:-1]
            gain = gs ** 2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g ** 2 / (total_h + 1)
            gain[(n < LEAF) | (len(g) - n < LEAF)] = 0
            if len(gain) and gain.max() > best:
                best, at = gain.max(), (f, int(gain.argmax()))
        return at

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                at = 2 ** level - 1 + node
                node = 2 * node + (x[rows, feature[at]] > cut[at])
            out += value[node]
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (places, rising values); equal x are pooled first."""
    xs, inverse = np.unique(x, return_inverse=True)
    weight = np.bincount(inverse).astype(float)
    mean = np.bincount(inverse, weights=y) / weight
    blocks: list[list[float]] = []  # value, weight, sum of x * weight
    for m, w, place in zip(mean, weight, xs):
        blocks.append([m, w, place * w])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            w = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / w, w, a[2] + b[2]])
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] for b in blocks])


@dataclass
class Model:
    lexicon: Lexicon | None
    trees: Trees | None
    places: np.ndarray | None
    values: np.ndarray | None
    rate: float = 0.0

    def score(self, data, offs) -> np.ndarray:
        if self.trees is None:
            return np.full(len(offs) - 1, self.rate)
        return np.clip(np.interp(self.trees.margin(features(data, offs, self.lexicon)), self.places, self.values), 0, 1)


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, text: str, id_col: str, label: str) -> DataFrame:
    """At most ``SAMPLE`` labelled training rows (part, toxic, text), written once."""
    some = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("toxic"))
            .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("id")))
    key = F.md5(F.col("id").cast("string"))
    some = smallest(some, key, SAMPLE, [key, "id", "toxic"])
    part = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("part")), F.lit(10))
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text).alias("text")).join(F.broadcast(some), "id")
    return materialize(rows.select(part.cast("int").alias("part"), "toxic", "text"), "toxic-sample")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "toxic") -> Model:
    sample = _sample(docs, labels, text, id_col, label)
    n = {(r["a"], r["toxic"]): r["n"] for r in sample.groupBy((F.col("part") < 5).alias("a"), "toxic")
         .agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, every = sum(v for k, v in n.items() if k[1] == 1), sum(n.values())
    rate = pos / every if every else 0.0
    if not (n.get((True, 1)) and n.get((True, 0)) and n.get((False, 1)) and n.get((False, 0))):
        return Model(None, None, None, None, rate)

    def emit(batches):
        import pyarrow as pa
        for b in batches:
            toxic = b.column(0).to_numpy()
            for i, data, offs in runs(b.column(1)):
                with np.errstate(over="ignore"):
                    doc, term = terms(data, offs)
                yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int64)),
                                                  pa.array(toxic[i + doc].astype(np.int64))], ["term", "toxic"])

    nt, nc = n[True, 1], n[True, 0]
    by = (sample.where("part < 5").select("toxic", "text").mapInArrow(emit, "term long, toxic long")
          .groupBy("term").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")))
    share = lambda c, of: (c + 0.5) / (of + 1.0)
    odds = F.log(share(F.col("t"), nt) / share(F.col("n") - F.col("t"), nc))
    kept = (by.where(F.col("t") >= LEAST_DOCS).select("term", odds.alias("w"), "t").where(F.col("w") > 1.0)
            .orderBy((F.col("w") * F.col("t")).desc(), "term").limit(LEXICON).toPandas())
    lex = Lexicon(kept["term"].to_numpy(np.int64).astype(np.uint64), kept["w"].to_numpy(float))

    def measure(batches):
        import pyarrow as pa
        for b in batches:
            x = [features(data, offs, lex) for _, data, offs in runs(b.column(2))]
            if x:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.concatenate(x).tolist())],
                                                 ["part", "toxic", "x"])

    rest = sample.where("part >= 5").mapInArrow(measure, "part int, toxic int, x array<double>").toPandas()
    # rows come in any order: sort them, so that the same rows give the same sums and the same trees
    x = np.array(rest["x"].tolist(), float)
    y, c = rest["toxic"].to_numpy(float), rest["part"].to_numpy() >= 8
    order = np.lexsort((*x.T, y, c))
    x, y, c = x[order], y[order], c[order]
    if len(set(y[~c])) < 2 or len(set(y[c])) < 2:
        c[:] = False
    trees = Trees(x[~c], y[~c])
    held = c if c.any() else ~c
    places, values = isotonic(trees.margin(x[held]), y[held])
    return Model(lex, trees, places, values, rate)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` with ``score`` and ``predicted`` (1 from 0.5 on); row-local."""
    from pyspark.sql import types as T

    keep = keep or ["doc_id"]
    src = docs.select(text_or_empty(text).alias("_text_of_score"), *keep)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            s = [model.score(data, offs) for _, data, offs in runs(b.column(0))]
            s = np.concatenate(s) if s else np.empty(0)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             [*names, "score", "predicted"])

    fields = src.schema.fields[1:]
    names = [f.name for f in fields]
    return src.mapInArrow(run, T.StructType([*fields, T.StructField("score", T.DoubleType()),
                                             T.StructField("predicted", T.IntegerType())]))


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted."""
    scored = score(docs, fit(docs, labels, text, id_col), text, [id_col])
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows scored 0.5 or more, same columns; one pass, nothing is shuffled.

    Without labelled training rows of both classes there is no model, and every row stays.
    """
    model = fit(docs, labels, text, id_col)
    if model.trees is None:
        return docs
    at = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            s = [model.score(data, offs) for _, data, offs in runs(b.column(at))]
            yield b.filter(pa.array((np.concatenate(s) if s else np.empty(0)) < 0.5))

    return docs.mapInArrow(run, docs.schema)
