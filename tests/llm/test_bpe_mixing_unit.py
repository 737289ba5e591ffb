"""Unit tests without Spark: byte-level BPE against tiktoken, apportionment against its definition."""

import random

import numpy as np
import pytest

from reviewspark.llm import bpe, mixing


@pytest.fixture(scope="module")
def tools():
    import public_tokenizers as P
    import tiktoken

    ranks = bpe.load_ranks(bpe.default_path())
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Codec(bpe.default_path(), P.PATTERN), enc


HARD = ["", " ", "\n", "a", " a", "  a", "a  b", "a \n b", "a\n\nb", " \n", "x \t y", "it's we'll 'd", " x y",
        "a b c", "été über", "é x", "\U0001f600 \U0001f600‍\U0001f525", "1234 12 a1", "a" * 5000,
        "ab " * 3000, "<|endoftext|> <|im_end|>", "\x00\x1c a\x1cb", "你好 世界", "!!! ... ?!", " " * 300 + "x", "﻿a"]


def test_ids_equal_tiktoken(tools):
    codec, enc = tools
    rng = random.Random(1)
    texts = HARD + ["".join(rng.choice("ab \n\t.,'1é  \U0001f600s") for _ in range(rng.randrange(60)))
                    for _ in range(2000)]
    for t, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == enc.encode_ordinary(t), repr(t)
        assert codec.decode(ids) == t.encode()


def test_chunks_join_to_the_text():
    for t in HARD:
        assert "".join(bpe._chunks(t)) == t


def test_memory_bound_changes_nothing(tools, monkeypatch):
    codec, enc = tools
    monkeypatch.setattr(bpe, "_CACHE", 2)
    for t in ("one two three", "three four five", "five six one"):
        assert np.frombuffer(codec.encode([t])[0], "<u4").tolist() == enc.encode_ordinary(t)


def brute_sainte_lague(shares, seats, caps):
    out = [0] * len(shares)
    for _ in range(seats):
        can = [i for i in range(len(shares)) if shares[i] > 0 and out[i] < caps[i]]
        if not can:
            break
        best = max(can, key=lambda i: (shares[i] / (2 * out[i] + 1), -i))
        out[best] += 1
    return out


def test_sainte_lague_against_seat_by_seat():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.randrange(1, 8)
        shares = [rng.choice([0.0, rng.random() * 100, 5.0, 5.0]) for _ in range(n)]
        caps = [rng.randrange(0, 60) for _ in range(n)]
        if not any(shares):
            continue
        seats = rng.randrange(0, 120)
        assert mixing.sainte_lague(shares, seats, caps) == brute_sainte_lague(shares, seats, caps)


def test_shard_quotas_add_up():
    shares, caps = [50.0, 20.0, 7.0], [100, 100, 100]
    parts = list(mixing.shard_quotas(shares, 77, caps, shard_blocks=10))
    assert [sum(x) for x in zip(*parts)] == mixing.sainte_lague(shares, 77, caps)
    assert all(sum(p) == 10 for p in parts[:-1])


def test_targets_cap_and_reshare():
    got = mixing.targets([100, 10, 100, 0], [5, 2, 1, 5], 315, 2)
    assert got[0] == 200 and got[1] == 20 and abs(got[2] - 95) < 1e-9 and got[3] == 0
    assert mixing.targets([], [], 0.0, 2) == []
