"""Byte-level BPE encoding and decoding through a sentencepiece model serialised from a rank file.

The model is written directly as protobuf bytes: every token of the vocabulary becomes a piece whose bytes
are mapped one to one on the characters U+0100..U+01FF, scored by its negative rank, with identity
normalisation and neither dummy prefix nor white-space escaping.  sentencepiece merges the best-scored
adjacent pair first, which is the lowest rank first: the byte-level BPE of the rank file.  Each match of the
splitting pattern is encoded separately; a match that is a token itself is that token.

Texts are split at white space first: in front of a white-space character that a non-space follows the
pattern always begins a new match, so the chunks between such places are split separately, and equal chunks
(then equal matches) are encoded once per worker.  The memory of what was encoded is bounded and never
changes a result.

Null text is empty: no ids.  Very long texts and matches are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
from pyspark.sql import DataFrame

from .common import worker_memory

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
_CACHE = 300_000  # chunks remembered per worker
_STEP = 500       # texts held as Python strings at a time
_BASE = 0x100


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, payload) -> bytes:
    """A protobuf field: varint for int, length-delimited for bytes, 32 bits for float."""
    if isinstance(payload, float):
        return _varint(number << 3 | 5) + struct.pack("<f", payload)
    if isinstance(payload, int):
        return _varint(number << 3) + _varint(payload)
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def mapped(data: bytes) -> str:
    return "".join(map(_MAP.__getitem__, data))


_MAP = [chr(_BASE + b) for b in range(256)]


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """ModelProto: pieces in rank order (id = rank), an unknown piece last; BPE; identity normaliser."""
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must count from 0 without gaps")
    out = [_field(1, _field(1, mapped(t).encode()) + _field(2, float(-r)) + _field(3, 1))
           for r, t in enumerate(tokens)]
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    trainer = (_field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens))  # BPE, size, unk_id
               + _field(41, (1 << 64) - 1) + _field(42, (1 << 64) - 1) + _field(43, (1 << 64) - 1))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        ranks = load_ranks(path)
        self.ranks = ranks
        self.tokens = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        self.split = regex.compile(pattern).findall
        self.matches: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)

    def _encode_matches(self, new: list[str]) -> None:
        hard, keys = [], []
        for m in new:
            data = m.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(data)
            if rank is None:
                hard.append(mapped(data))
                keys.append(m)
            else:
                self.matches[m] = rank.to_bytes(4, "little")
        if hard:
            for m, ids in zip(keys, self.sp.encode(hard, num_threads=1)):
                self.matches[m] = np.array(ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.chunks) > _CACHE:
            self.chunks.clear()
        if len(self.matches) > _CACHE:
            self.matches.clear()
        chunked = [_chunks(t) for t in texts]
        known = self.chunks
        new = {c for cs in chunked for c in cs if c not in known}
        parts = {c: self.split(c) for c in new}
        unseen = {m for ms in parts.values() for m in ms if m not in self.matches}
        self._encode_matches(list(unseen))
        get = self.matches.__getitem__
        for c, ms in parts.items():
            known[c] = b"".join(map(get, ms))
        return [b"".join(map(known.__getitem__, cs)) for cs in chunked]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _chunks(text: str) -> list[str]:
    """Cut in front of every space that a non-space follows; the pieces joined are the text."""
    parts = text.split(" ")
    out, held = [], parts[0]
    for p in parts[1:]:
        if p and not p[0].isspace():
            if held:
                out.append(held)
            held = " " + p
        else:  # white space goes on: the match around it is settled later
            held += " " + p
    if held:
        out.append(held)
    return out


def _texts(column):
    for i in range(0, len(column), _STEP):
        yield [t or "" for t in column[i:i + _STEP].to_pylist()]


def codec(path: str, pattern: str) -> Codec:
    kept, key = worker_memory(), ("bpe", path, pattern)
    if key not in kept:
        kept[key] = Codec(path, pattern)
    return kept[key]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def encode(df: DataFrame, text: str = "text", id_col: str = "doc_id", path: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """id, ids (binary: little-endian unsigned 32-bit), n_tokens; row-local, no shuffle."""
    import public_tokenizers
    from pyspark.sql import functions as F

    path, pattern = path or default_path(), pattern or public_tokenizers.PATTERN

    def run(batches):
        import pyarrow as pa
        for b in batches:
            ids = [x for part in _texts(b.column(1)) for x in codec(path, pattern).encode(part)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.large_binary()).cast(pa.binary()) if sum(map(len, ids)) < 1 << 31
                 else pa.array(ids, pa.large_binary()), pa.array([len(i) // 4 for i in ids], pa.int64())],
                ["id", "ids", "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(
        run, f"id {kind}, ids binary, n_tokens long")
    return out.withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, text: str = "text", id_col: str = "doc_id", path: str | None = None,
               pattern: str | None = None) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256: encodes every text, decodes the ids again.

    One pass: ids leave the worker only as digests; ``encode`` returns them.
    """
    import public_tokenizers
    from pyspark.sql import functions as F

    path, pattern = path or default_path(), pattern or public_tokenizers.PATTERN

    def run(batches):
        import pyarrow as pa
        for b in batches:
            c = codec(path, pattern)
            rows = [(len(i) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(c.decode(i)).hexdigest())
                    for part in _texts(b.column(1)) for i in c.encode(part)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string())))],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(
        run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
