"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF transitions beside them.

Base spans are the leftmost non-overlapping matches of each kind's pattern that pass its check (no retries).
The tagger is trained in numpy on windows labelled with base spans (a bounded sample, ``SAMPLE`` windows,
smallest hash first) and finds spans that the patterns miss because a longer match in front of them failed its
check: an address behind a version number, a card number behind a year.

Tagging.  All four kinds hold a digit or an ``@``.  Every window of ``WINDOW`` characters, half overlapping the
next, that holds one is decoded (Viterbi); windows without either are all outside.  Spans of all windows of
a text are then reconciled globally: spans cut by a window's edge give way to the neighbour window's whole
span, and the rest is chosen by falling mean score so that no two overlap.  A chosen span is reported if its
text is a whole valid item of its kind and it overlaps no base span.  Base spans always stay.

Offsets are code points, end exclusive.  Null and empty texts have no spans.  Very long texts are scanned
whole, in linear time.  Only the text and id columns are read.  Without any labelled span in the sample there
is no tagger and the base spans are the result.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, smallest, text_or_empty

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
SAMPLE = 2000
HIDDEN = 20
EPOCHS, BATCH, RATE = 8, 64, 0.02

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where no digit stands before it, which keeps long runs of digits linear
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGNAL = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def valid(kind: str, s: str) -> bool:
    """Whether ``s`` as a whole is an item of the kind."""
    if kind == "email":
        at = s.find("@")
        return at > 0 and set(s[:at]) <= _LOCAL and bool(_DOMAIN.fullmatch(s, at + 1))
    if kind == "ip":
        return bool(_IP.fullmatch(s)) and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))
    if kind == "card":
        d = _digits(s)
        return bool(_CARD.fullmatch(s)) and 12 <= len(d) <= 19 and luhn(d)
    return bool(_PHONE.fullmatch(s)) and 9 <= len(_digits(s)) <= 15


def _emails(text: str):
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = at = m.end()
        else:
            at += 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if valid("ip", m[0])]
    out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text)
            if len(m[0]) >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    out.sort()
    return out


# ---- characters as classes -----------------------------------------------------------------------------------------
_SINGLE = "@.-_+%() \n,:/;#"
PAD, N_CLASS = 0, 6 + len(_SINGLE)


def _class_table() -> np.ndarray:
    t = np.full(128, 5, np.int64)  # other
    for c in range(128):
        ch = chr(c)
        t[c] = 1 if ch.isdigit() else 2 if ch.islower() else 3 if ch.isupper() else 5
    for k, ch in enumerate(_SINGLE):
        t[ord(ch)] = 6 + k
    return t


_CLASS = _class_table()


def classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(code < 128, _CLASS[np.minimum(code, 127)], 4)


# tags: 0 outside; 1 + 2k begin, 2 + 2k inside of kind k
N_TAG = 1 + 2 * len(KINDS)
_ALLOWED = np.ones((N_TAG, N_TAG), bool)
for _k in range(len(KINDS)):
    _ALLOWED[:, 2 + 2 * _k] = False
    _ALLOWED[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = True
_FORBID = np.where(_ALLOWED, 0.0, -1e4)
_START = np.where(np.arange(N_TAG) % 2 == 0, -1e4, 0.0) * (np.arange(N_TAG) > 0)


def tag_row(spans, lo: int, hi: int) -> np.ndarray:
    """Tags of characters lo..hi; a span cut by the left edge starts with its begin tag."""
    t = np.zeros(hi - lo, np.int64)
    for a, k, b in spans:
        a, b = max(a, lo), min(b, hi)
        if a < b and not t[a - lo:b - lo].any():
            t[a - lo] = 1 + 2 * k
            t[a + 1 - lo:b - lo] = 2 + 2 * k
    return t


def windows(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an ``@``."""
    out, last = [], -1
    for m in _SIGNAL.finditer(text):
        for w in range(max(0, (m.start() - WINDOW) // STRIDE + 1), m.start() // STRIDE + 1):
            if w > last:
                out.append(w * STRIDE)
                last = w
    return out


# ---- the network ---------------------------------------------------------------------------------------------------
def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _logsumexp(x, axis):
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Bidirectional LSTM over character classes, linear scores, CRF transitions."""

    p: dict

    @staticmethod
    def new(seed: int = 7, hidden: int = HIDDEN) -> "Tagger":
        r = np.random.default_rng(seed)
        p = {}
        for d in "fb":
            p[f"w{d}"] = r.normal(0, 0.3, (N_CLASS, 4 * hidden))
            p[f"u{d}"] = r.normal(0, 0.5 / np.sqrt(hidden), (hidden, 4 * hidden))
            p[f"b{d}"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
        p["o"] = r.normal(0, 0.3, (2 * hidden, N_TAG))
        p["c"] = np.zeros(N_TAG)
        p["t"] = np.zeros((N_TAG, N_TAG))
        return Tagger(p)

    def _run(self, x, d, keep=False):
        p, (n, steps) = self.p, x.shape
        hid = p[f"u{d}"].shape[0]
        h, c = np.zeros((n, hid)), np.zeros((n, hid))
        out, trace = np.empty((steps, n, hid)), []
        for s in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            z = p[f"w{d}"][x[:, s]] + h @ p[f"u{d}"] + p[f"b{d}"]
            gates = _sigmoid(z[:, :3 * hid])
            i, f, o = gates[:, :hid], gates[:, hid:2 * hid], gates[:, 2 * hid:]
            g = np.tanh(z[:, 3 * hid:])
            was = c
            c = f * c + i * g
            tc = np.tanh(c)
            if keep:
                trace.append((s, h, was, i, f, o, g, tc))
            h = o * tc
            out[s] = h
        return out, trace

    def emissions(self, x) -> np.ndarray:
        """(steps, rows, tags)."""
        both = np.concatenate([self._run(x, "f")[0], self._run(x, "b")[0]], 2)
        return both @ self.p["o"] + self.p["c"]

    def decode(self, x) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (rows, steps) and the probability the scores alone give each chosen tag."""
        e = self.emissions(x)
        steps, n, _ = e.shape
        trans = self.p["t"] + _FORBID
        score, back = e[0] + _START, np.zeros((steps, n, N_TAG), np.int8)
        for s in range(1, steps):
            every = score[:, :, None] + trans
            back[s] = every.argmax(1)
            score = every.max(1) + e[s]
        tags = np.zeros((n, steps), np.int64)
        tags[:, -1] = score.argmax(1)
        for s in range(steps - 1, 0, -1):
            tags[:, s - 1] = back[s][np.arange(n), tags[:, s]]
        e = e - _logsumexp(e, 2)[:, :, None]
        return tags, np.take_along_axis(e.transpose(1, 0, 2), tags[:, :, None], 2)[:, :, 0]

    def loss(self, x, y) -> tuple[float, dict]:
        """Mean negative log likelihood of the tag rows, and the gradient of every parameter."""
        p, (n, steps) = self.p, x.shape
        hf, tf = self._run(x, "f", True)
        hb, tb = self._run(x, "b", True)
        both = np.concatenate([hf, hb], 2)
        e = both @ p["o"] + p["c"]
        trans = p["t"] + _FORBID
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0] + _START
        for s in range(1, steps):
            alpha[s] = _logsumexp(alpha[s - 1][:, :, None] + trans, 1) + e[s]
        for s in range(steps - 2, -1, -1):
            beta[s] = _logsumexp(trans[None] + (e[s + 1] + beta[s + 1])[:, None, :], 2)
        z = _logsumexp(alpha[-1], 1)
        at = np.arange(n)
        gold = sum(e[s][at, y[:, s]] for s in range(steps)) + sum(trans[y[:, s - 1], y[:, s]] for s in range(1, steps))
        de = np.exp(alpha + beta - z[None, :, None])
        g = {k: np.zeros_like(v) for k, v in p.items()}
        for s in range(1, steps):
            pair = alpha[s - 1][:, :, None] + trans + (e[s] + beta[s])[:, None, :] - z[:, None, None]
            g["t"] += np.exp(pair).sum(0)
            np.add.at(g["t"], (y[:, s - 1], y[:, s]), -1.0)
        for s in range(steps):
            de[s][at, y[:, s]] -= 1.0
        g["o"] = np.einsum("snh,snt->ht", both, de)
        g["c"] = de.sum((0, 1))
        dboth = de @ p["o"].T
        hid = hf.shape[2]
        for d, trace, dh_all in (("f", tf, dboth[:, :, :hid]), ("b", tb, dboth[:, :, hid:])):
            dh, dc = np.zeros((n, hid)), np.zeros((n, hid))
            for s, h, was, i, f, o, gg, tc in reversed(trace):
                dh = dh + dh_all[s]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * gg * i * (1 - i), dc * was * f * (1 - f), dh * tc * o * (1 - o),
                                     dc * i * (1 - gg * gg)], 1)
                np.add.at(g[f"w{d}"], x[:, s], dz)
                g[f"u{d}"] += h.T @ dz
                g[f"b{d}"] += dz.sum(0)
                dh, dc = dz @ p[f"u{d}"].T, dc * f
        return float((z - gold).mean()), {k: v / n for k, v in g.items()}


def train(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Tagger:
    """Adam on shuffled batches; the same rows give the same weights."""
    net, r = Tagger.new(seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v2 = {k: np.zeros_like(v) for k, v in net.p.items()}
    step, total = 0, max(1, epochs * -(-len(x) // BATCH))
    for _ in range(epochs):
        order = r.permutation(len(x))
        for a in range(0, len(x), BATCH):
            rows = order[a:a + BATCH]
            _, g = net.loss(x[rows], y[rows])
            norm = np.sqrt(sum((q * q).sum() for q in g.values()))
            scale = min(1.0, 5.0 / (norm + 1e-9))
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for k in net.p:
                q = g[k] * scale
                m[k] = 0.9 * m[k] + 0.1 * q
                v2[k] = 0.999 * v2[k] + 0.001 * q * q
                net.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
    return net


# ---- spans of whole texts ------------------------------------------------------------------------------------------
def tagged_spans(net: Tagger, texts: list[str], batch: int = 256) -> list[list[tuple[int, int, int]]]:
    """Reconciled spans (start, kind number, end) of each text, before any check of their content."""
    code = [classes(t) for t in texts]
    jobs = [(i, w) for i, t in enumerate(texts) for w in windows(t)]
    found: list[list[tuple]] = [[] for _ in texts]
    for a in range(0, len(jobs), batch):
        part = jobs[a:a + batch]
        x = np.full((len(part), WINDOW), PAD, np.int64)
        for r, (i, w) in enumerate(part):
            piece = code[i][w:w + WINDOW]
            x[r, :len(piece)] = piece
        tags, sure = net.decode(x)
        for r, (i, w) in enumerate(part):
            if tags[r].any():
                found[i] += _spans_of(tags[r], sure[r], w, len(code[i]))
    return [_reconcile(f) for f in found]


def _spans_of(tags, sure, at: int, length: int):
    s, n = 0, len(tags)
    while s < n:
        if tags[s] == 0:
            s += 1
            continue
        kind = (tags[s] - 1) // 2
        e = s + 1
        while e < n and tags[e] == 2 + 2 * kind:
            e += 1
        cut = (s == 0 and at > 0) or (e == n and at + n < length)
        yield (cut, -float(sure[s:e].mean()), at + s, int(kind), min(at + e, length))
        s = e


def _reconcile(spans: list[tuple]) -> list[tuple[int, int, int]]:
    """Whole spans before cut ones, then by score; no two overlap.  A span is dropped only for one that stays."""
    out: list[tuple[int, int, int]] = []
    import bisect
    for cut, score, a, kind, b in sorted(set(spans)):
        k = bisect.bisect_left(out, (a, -1, -1))
        if (k == 0 or out[k - 1][2] <= a) and (k == len(out) or out[k][0] >= b):
            out.insert(k, (a, kind, b))
    return out


def all_spans(texts: list[str], net: Tagger | None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    if net is None:
        return [(b, b) for b in base]
    has = [i for i, t in enumerate(texts) if _SIGNAL.search(t)]
    more = dict(zip(has, tagged_spans(net, [texts[i] for i in has])))
    out = []
    for i, b in enumerate(base):
        cover = sorted((x[0], x[2]) for x in b)
        added = []
        for a, k, e in more.get(i, ()):
            piece = texts[i][a:e]
            cleaned = piece.strip(" .,:;()\n-") if k != 3 else piece.strip(" .,:;()\n-")
            a += piece.find(cleaned) if cleaned else 0
            e = a + len(cleaned)
            if cleaned and valid(KINDS[k], cleaned) and not any(x < e and a < y for x, y in cover):
                added.append((a, k, e))
        out.append((b, sorted(b + added)))
    return out


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# ---- Spark ---------------------------------------------------------------------------------------------------------
def _training_rows(docs: DataFrame, text: str, id_col: str) -> tuple[np.ndarray, np.ndarray]:
    """At most ``SAMPLE`` labelled windows, those with the smallest hash; half of them hold a span."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                spans = base_spans(t)
                code = None
                for w in windows(t):
                    code = classes(t) if code is None else code
                    hi = min(len(t), w + WINDOW)
                    near = [s for s in spans if s[0] < hi and s[2] > w]
                    y = tag_row(near, w, hi)
                    key = hashlib.md5(f"{i}/{w}".encode()).hexdigest()
                    rows.append((key, bool(y.any()), code[w:hi].astype(np.uint8).tobytes(), y.astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in
                                              enumerate((pa.string(), pa.bool_(), pa.binary(), pa.binary()))],
                                             ["key", "has", "x", "y"])

    src = docs.select(F.col(id_col).cast("string").alias("id"), text_or_empty(text).alias("text")).where(
        F.col("text").rlike("[0-9@]"))
    rows = materialize(src.mapInArrow(run, "key string, has boolean, x binary, y binary"), "pii-windows")
    order = ["key", "x", "y"]
    found = [r for has in (True, False)
             for r in smallest(rows.where(F.col("has") == has), F.col("key"), SAMPLE // 2, order).collect()]
    x, y = np.full((len(found), WINDOW), PAD, np.int64), np.zeros((len(found), WINDOW), np.int64)
    for k, r in enumerate(found):
        x[k, :len(r["x"])] = np.frombuffer(r["x"], np.uint8)
        y[k, :len(r["y"])] = np.frombuffer(r["y"], np.uint8)
    return x, y


def fit(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> Tagger | None:
    x, y = _training_rows(docs, text, id_col)
    return train(x, y) if y.any() else None


def find_pii(docs: DataFrame, net: Tagger | None, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: id, base and all spans as ``array<struct<start,kind,end>>``; row-local."""
    kind = docs.schema[id_col].dataType.simpleString()
    spans = "array<struct<start:int,kind:string,end:int>>"

    def run(batches):
        import pyarrow as pa
        kind_of = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
        row = lambda s: [{"start": a, "kind": KINDS[k], "end": e} for a, k, e in s]
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                found = all_spans(part.column(1).to_pylist(), net)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([row(x) for x, _ in found], kind_of), pa.array([row(x) for _, x in found], kind_of)],
                    ["id", "base", "spans"])

    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text).alias("text"))
    return src.mapInArrow(run, f"id {kind}, base {spans}, spans {spans}").withColumnRenamed("id", id_col)


def pii_report(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, n_email .. n_phone (base spans), base_sha256, spans (all, as kind:start:end)."""
    found = find_pii(docs, fit(docs, text, id_col), text, id_col)
    show = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        id_col, *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(show("base"), 256).alias("base_sha256"), show("spans").alias("spans"))
