"""Base patterns against plain regexes, the gradient against differences, decoding against enumeration."""

import itertools
import random
import re

import numpy as np

from reviewspark.llm import pii

PLAIN = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


CHECK = {"email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
         "card": lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s)),
         "phone": lambda s: 9 <= len(digits(s)) <= 15}


def plain(text):
    return sorted((m.start(), k, m.end()) for k, kind in enumerate(pii.KINDS)
                  for m in PLAIN[kind].finditer(text) if CHECK[kind](m[0]))


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(5)
    texts = ["", "a@b", "a@b.c", "a@b@c.d.e", "@x.y", "x@y..z", "1.2.3.4.5.6.7.8", "1.2.3.999 1.2.3.4", "001.2.3.4",
             "4111 1111 1111 1111", "2024 4111 1111 1111 1111", "4111-1111-1111-1111-", "+1 (269) 555-3296", "+1 2 ", "++12345 6789)",
             "é a.b@c-d.é", "٣.٣.٣.٣", "1" * 300 + ".1.1.1"]
    texts += ["".join(rng.choice("a1.@+- (9Z\n4é") for _ in range(rng.randrange(40))) for _ in range(20000)]
    for t in texts:
        assert pii.base_spans(t) == plain(t), repr(t)


def test_long_runs_are_linear():
    for t in ("a" * 300_000 + "@", "1" * 300_000, "1." * 200_000, "+" + "1 " * 200_000, "@" * 300_000):
        pii.base_spans(t)
        pii.windows(t)


def test_gradient():
    net = pii.Tagger.new(3, hidden=4)
    net.p["t"] += np.random.default_rng(0).normal(0, 0.1, net.p["t"].shape)
    x = np.random.default_rng(1).integers(0, pii.N_CLASS, (3, 6))
    y = np.array([[0, 1, 2, 2, 0, 3], [1, 2, 0, 0, 5, 6], [0, 0, 0, 7, 8, 8]])
    _, g = net.loss(x, y)
    rng = np.random.default_rng(2)
    for k, v in net.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in v.shape)
            old = v[at]
            v[at] = old + 1e-5
            up = net.loss(x, y)[0]
            v[at] = old - 1e-5
            down = net.loss(x, y)[0]
            v[at] = old
            assert abs((up - down) / 2e-5 - g[k][at]) < 1e-4, k


def test_decode_is_the_best_path():
    net = pii.Tagger.new(4, hidden=3)
    x = np.random.default_rng(1).integers(0, pii.N_CLASS, (2, 4))
    e, trans = net.emissions(x), net.p["t"] + pii._FORBID
    tags, _ = net.decode(x)
    for r in range(2):
        best = max(itertools.product(range(pii.N_TAG), repeat=4), key=lambda p: pii._START[p[0]] + sum(
            e[s][r, p[s]] for s in range(4)) + sum(trans[p[s - 1], p[s]] for s in range(1, 4)))
        assert tuple(tags[r]) == best


def _made(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("thenadorislyé") for _ in range(rng.randrange(1, 9)))
    out = []
    for _ in range(n):
        item = rng.choice([f"{word()}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", "4532 0151 1283 0366",
                           ".".join(str(rng.randrange(256)) for _ in range(4)), f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}",
                           str(rng.randrange(3000)), f"v{rng.randrange(9)}.{rng.randrange(9)}"])
        out.append(" ".join([word() for _ in range(8)] + [item] + [word() for _ in range(8)]))
    return out


def _rows(texts):
    x, y = np.zeros((len(texts), pii.WINDOW), int), np.zeros((len(texts), pii.WINDOW), int)
    for i, t in enumerate(texts):
        hi = min(len(t), pii.WINDOW)
        x[i, :hi] = pii.classes(t)[:hi]
        y[i, :hi] = pii.tag_row(pii.base_spans(t), 0, hi)
    return x, y


def test_learns_and_adds_what_the_patterns_miss():
    net = pii.train(*_rows(_made(500, 1)), epochs=8)
    x, y = _rows(_made(200, 2))
    tags, _ = net.decode(x)
    hit = (tags == y)[y > 0].mean()
    assert hit > 0.9 and (tags == y).mean() > 0.98
    text = " ".join(_made(40, 3))
    (base, every), = pii.all_spans([text], net)
    assert set(base) <= set(every) and base == plain(text)
    for a, k, b in every:
        assert pii.valid(pii.KINDS[k], text[a:b])


def test_reconcile_prefers_whole_spans():
    got = pii._reconcile([(True, -0.1, 0, 0, 5), (False, -0.5, 3, 0, 9), (False, -0.4, 12, 1, 20), (False, -0.4, 12, 1, 20)])
    assert got == [(3, 0, 9), (12, 1, 20)]
