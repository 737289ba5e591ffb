"""Spelling variants, hard negatives and packing against brute force, with nulls, empty and long texts, ties, repeated
rows, empty tables and extra columns whose names clash with internal ones."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from reviewspark.llm import hard_negatives, packing, spelling

SCHEMA = "doc_id long, text string, word string, n long, row long, length long, shard long, id string"


# ---- spelling -----------------------------------------------------------------


def brute_variants(rows, least=5, ratio=5):
    low = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    count = collections.Counter()
    for i, t in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = r.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            count[r[:h % len(r)] + r[h % len(r) + 1:] if h % 199 == 0 else r] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= least}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if a == b or len(b) - len(a) > 1:
            return False
        k = 0
        while k < len(a) and a[k] == b[k]:
            k += 1
        return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]

    known = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, vs in known.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, n, len(known[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items()}


def spelling_rows():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 11))) for _ in range(40)]
    words = []
    for w in base:
        words += [w] * rng.choice([6, 30, 200])
        for _ in range(12):  # chains of edits: edits of edits
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + rng.choice("abcé÷") + w[k + 1:], w[:k] + w[k + 1:], w[:k] + rng.choice("abc") + w[k:]])
            words += [w.upper() if rng.random() < 0.2 else w] * rng.choice([5, 6, 1, 7, 40])
    words += ["aaaaaa"] * 9 + ["aaaaaaa"] * 9 + ["baaaaaa"] * 50 + ["z" * 3000] * 5 + [("z" * 2999) + "y"] * 25
    words += ["chainaa"] * 7 + ["chainab"] * 45 + ["chaincb"] * 300
    rng.shuffle(words)
    texts = [" ".join(words[k:k + 40]) for k in range(0, len(words), 40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1]), (None, None), (9000, ""), (9001, " \n1.2"),
                                                    (9002, " ".join(words * 3))]
    return rows


@pytest.fixture(scope="module")
def spelled():
    rows = spelling_rows()
    return rows, brute_variants(rows)


@pytest.mark.parametrize("tile", [512, 3])
def test_spelling(spark, spelled, tile):
    rows, want = spelled
    df = spark.createDataFrame([(*r, "clash", 1, 2, 3, 4, "x") for r in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in spelling.variants(df, tile=tile).select("word", "n", "n_near", "form", "form_n", "root").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert max(n for _, _, n, *_ in want) > 2 and any(f and r != f for _, _, _, f, _, r in want)


def test_spelling_of_an_empty_table(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).collect() == []


def test_every_bucket_ends_small(spark):
    """Tiles open until they are small: no bucket holds more than the limit unless one code point is open."""
    words = spark.createDataFrame([(f"pre{a}{b}{c}fix", 5) for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"], "word string, n long")
    for t in spelling.tiles(words, tile=10):
        for r in t.groupBy(*spelling.BUCKET).count().collect():
            assert r["count"] <= 10 or r.m - r.a - r.b == 1


# ---- hard negatives ------------------------------------------------------------


def brute_negatives(rows, every=100, low=80):
    ok = [(i, k, lab, [math.floor(256 * float(x)) for x in v]) for k, (i, lab, v) in enumerate(rows)
          if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    key = lambda s, i: (-s, i is None, i or 0)
    for i, k, lab, q in ok:
        if i is None or i % every:
            continue
        score = [(sum(a * b for a, b in zip(q, v)), j, lab2) for j, k2, lab2, v in ok if k2 != k and len(v) == len(q)]
        for ps, pid in [(s, j) for s, j, l2 in sorted(score, key=lambda x: key(*x[:2])) if l2 == lab][:5]:
            inside = sorted(((s, j) for s, j, l2 in score if l2 != lab and low * ps <= 100 * s <= 100 * ps), key=lambda x: key(*x))[:5]
            out += [(i, pid, r + 1, j, ps, s) for r, (s, j) in enumerate(inside)]
    return collections.Counter(out)


def vectors(n=260, d=12, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(int(i), int(rng.integers(0, 3)), [float(x) for x in np.float32(rng.normal(0, 1, d))]) for i in range(n)]
    rows += [(1000 + i, 1, rows[0][2]) for i in range(60)] + [(2000 + i, 2, rows[0][2]) for i in range(60)]   # ties, a hot vector
    rows += [(100, 1, rows[5][2]), (100, 1, rows[5][2]), (None, 2, rows[0][2]), (None, 0, rows[1][2]), (300, None, rows[1][2]),
             (400, 1, None), (500, 1, [1.0] * (d - 1) + [None]), (600, 1, [float("nan")] + [0.0] * (d - 1)),
             (700, 1, [float("inf")] * d), (800, 1, [1.0, 2.0]), (801, 2, [1.0, 2.0]), (802, 1, [1.0, 2.0]), (900, 2, []), (901, 2, []),
             (902, 1, []), (1100, 0, [0.0] * d), (1300, 7, rows[9][2]), (-100, 0, rows[3][2]), (1400, 0, [-x for x in rows[4][2]])]
    return rows


VECTORS = "vec_id long, label int, embedding array<float>, row int, anchor string, score int, place int"


@pytest.mark.parametrize("anchors", [2048, 3])
def test_hard_negatives(spark, anchors):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, "clash", 2, 3) for r in rows], VECTORS).repartition(4)
    got = hard_negatives.mine(df, anchors=anchors)
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert collections.Counter(tuple(r) for r in got.select(*cols).collect()) == brute_negatives(rows)


def test_hard_negatives_of_an_empty_table(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS)).collect() == []


def test_large_integers_stay_exact(spark):
    rows = [(100, 1, [1e7, 1.0]), (1, 1, [1e7, 2.0]), (2, 0, [1e7, 1.5]), (3, 0, [1e7, 1.25]), (4, 0, [1e7, 3.0])]
    df = spark.createDataFrame([(i, lab, v) for i, lab, v in rows], "vec_id long, label int, embedding array<double>")
    got = [(r.negative_id, r.negative_score) for r in hard_negatives.mine(df).orderBy("rank").collect()]
    dot = lambda a, b: sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b))
    assert dot(rows[0][2], rows[1][2]) > 1 << 53
    assert got == [(2, dot(rows[0][2], rows[2][2])), (3, dot(rows[0][2], rows[3][2]))]


def test_the_scan_rules_rows_out_early():
    """The bounds do their work: rows far from an anchor leave before all dimensions are read."""
    rng = np.random.default_rng(0)
    v = rng.integers(-3, 4, (4000, 32))
    v[:, 0] = np.where(np.arange(4000) < 20, 900, rng.integers(-900, 0, 4000))
    cols, seen = hard_negatives.Columns(np.arange(4000), v), []
    q = np.r_[50, np.ones(31, int)]

    def still(low, high):
        seen.append(len(low))
        return high >= hard_negatives._kth(low, 5)
    at, s = cols.scan(q, np.arange(4000), still)
    assert seen[0] == 4000 and seen[1] <= 20 and set(np.argsort(-(v @ q), kind="stable")[:5]) <= set(at)
    assert (s == (v @ q)[at]).all()


# ---- packing -------------------------------------------------------------------


def texts():
    rng = random.Random(11)
    words = ["alpha", "Beta's", "gämma", "x1y2", "naïve,", "—", "don't", "日本語", "e.g.", "\n", "\t", "  ", "   \n ", " ", " a"]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", "", "s", "ing"]) for _ in range(rng.randrange(1, 400)))) for i in range(120)]
    rows += [(500, " ".join(rng.choice(words) for _ in range(30000))), (501, "a" * 20000), (502, None), (503, ""), (None, "null id"),
             (None, None), (504, "ends <|endoftext|> here"), (505, "<|endoftext|>"), (506, "x\x1cy \x85z"), (507, "tail  "), (508, " \n\n  lead")]
    return rows + rows[:7]


@pytest.fixture(scope="module")
def packed(spark):
    rows = texts()
    df = spark.createDataFrame([(*r, "clash", 1, 2, 3, 4, "x") for r in rows], SCHEMA).repartition(4)
    return rows, packing.pack_round_trip(df, shard=16).collect()


def test_pieces_are_the_librarys_ids(packed):
    import public_tokenizers
    from tokenizers import Tokenizer
    rows, got = packed
    tok = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    want = collections.Counter()
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *(c for c in range(len(ids) % 2048, len(ids), 2048) if c), len(ids)]
        for p, (a, z) in enumerate(zip(cuts, cuts[1:])):
            want[i, p, a, z - a, zlib.crc32(ids[a:z].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want


def test_sequences_are_gapless_and_few(packed):
    _, got = packed
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= 2048
    # shards of 16 pieces cost a few bins; in one shard the packing is at least as good as falling best fit
    size = np.array([r.length for r in got])
    best = packing.best_fit(size, np.argsort(-size, kind="stable"), np.full(len(size), -1), 2048)
    assert len(by) <= best.max() + 1 + -(-len(got) // 16)


def test_one_shard_packs_as_well_as_falling_best_fit(spark):
    rng = np.random.default_rng(2)
    size = np.minimum(rng.lognormal(6.2, 0.8, 700).astype(int) + 1, 2048)
    items = spark.createDataFrame([(i, int(x)) for i, x in enumerate(size)], "row long, length long")
    best = packing.best_fit(size, np.argsort(-size, kind="stable"), np.full(len(size), -1), 2048)
    assert packing.place(items).select("sequence_id").distinct().count() <= best.max() + 1


def test_packing_reruns_agree_and_empty(spark):
    items = spark.range(300).selectExpr("id as row", "id * 37 % 1900 + 1 as length")
    one, two = (sorted(map(tuple, packing.place(items.repartition(n), shard=40).collect())) for n in (2, 5))
    assert one == two and len(one) == 300
    assert packing.pack_round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_crossover_and_mutation_keep_every_piece():
    rng = np.random.default_rng(4)
    size = rng.integers(1, 900, 200)
    a, b = packing.seeded_population(size, 1000, rng, False)[:2]
    for child in (packing.crossover(size, a, b, 1000, rng), packing.mutate(size, a, 1000, rng)):
        fill = np.bincount(child, size)
        assert len(child) == 200 and child.min() == 0 and fill.max() <= 1000 and fill.min() > 0


def test_evolution_beats_best_fit_on_triplets():
    """Three pieces fill a bin exactly: falling best fit needs more bins than the planted packing, evolution fewer."""
    rng = np.random.default_rng(7)
    sizes = []
    for _ in range(40):
        x, y = rng.integers(250, 340), rng.integers(300, 380)
        sizes += [x, y, 1000 - x - y]
    size = np.array(sizes)
    first = packing.best_fit(size, np.argsort(-size, kind="stable"), np.full(len(size), -1), 1000)
    held = packing.seeded_population(size, 1000, rng, True)
    held = packing.evolve(size, held, 1000, rng, 60)
    assert packing.fitness(size, held[0], 1000) < packing.fitness(size, first, 1000)
    assert packing.fitness(size, held[0], 1000)[0] >= packing.lower_bound(size, 1000) == 40


def test_islands_migrate_and_finish(spark):
    rng = np.random.default_rng(9)
    items = spark.createDataFrame([(i, int(x)) for i, x in enumerate(rng.integers(500, 1100, 400))], "row long, length long")
    best = packing.evolved(packing._shard_rows(items, 4, 1, 0), 2048, "t")
    rows = best.collect()
    assert len(rows) == 4 and sum(len(r.sizes) // 8 for r in rows) == 400
    for r in rows:
        size, bins = np.frombuffer(r.sizes, "<i8"), np.frombuffer(r.bins, "<i4")
        assert np.bincount(bins, size).max() <= 2048 and bins.max() + 1 == r.n_bins


# ---- mended operators -------------------------------------------------------------


def test_smallest_is_the_sorted_head(spark):
    from pyspark.sql import functions as F
    from reviewspark.llm.common import smallest
    df = spark.range(3000).select("id", F.md5(F.col("id").cast("string")).alias("k")).repartition(6)
    want = [r.id for r in df.orderBy("k", "id").limit(70).collect()]
    assert [r.id for r in smallest(df, F.col("k"), 70, ["k", "id"]).collect()] == want
    assert smallest(df, F.col("k"), 5000, ["k", "id"]).count() == 3000 and smallest(df.where("false"), F.col("k"), 5, ["k"]).count() == 0


def test_without_a_model_no_document_is_dropped(spark):
    from reviewspark.llm import toxicity
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.drop_toxic(docs, labels).count() == 20
    assert toxicity.drop_toxic(docs, labels.where("false")).count() == 20


def test_stages_with_clashing_names(spark):
    from reviewspark.llm import exact_dedup, mixing, near_dup
    rows = [(i, f"word{i % 9} " * (i % 7 + 1), f"s{i % 3}", i, "x", 2, i) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _rows long, `_mix_key` string, `a.b` int, _k long")
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and out.count() > 0
    assert near_dup.drop_near_copies(df).columns == df.columns
    one = exact_dedup.drop_exact_copies(df)
    assert one.columns == df.columns and one.count() == len({" ".join(r[1].split(" ")) for r in rows})


def test_special_strings_are_the_librarys_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    from reviewspark.llm import token_file
    path = public_tokenizers.path(token_file.VOCABULARY)
    tok, own = Tokenizer.from_file(path), token_file.WordTokenizer(path)
    texts = ["a <|startoftext|> b", "<|endoftext|>", "x<|endoftext|>Y, z.", "plain Words, here.", "", "<|ENDOFTEXT|>"]
    assert own.chunked and own.lower
    assert [np.frombuffer(x, own.kind).tolist() for x in own.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    # a cased vocabulary is not lower-cased: it is left to the library where chunks would not do
    cased = public_tokenizers.path("byte_bpe_50k.json")
    tok, own = Tokenizer.from_file(cased), token_file.WordTokenizer(cased)
    texts = ["Two Words two words", "a<|endoftext|>B", "x  y\nz"]
    assert [np.frombuffer(x, own.kind).tolist() for x in own.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
