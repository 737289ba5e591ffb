"""Token ids in frequency-ranked, byte-aligned variable-length coding with separate control bytes.

Ids are replaced by their rank in the whole corpus's frequency order, so that common tokens take one byte.
Each value is stored in 1 to 4 bytes; two bits per value, four values per control byte, tell its length.
Control and data bytes lie apart, so numpy decodes a block by looking the control bytes up in a table of
lengths, summing them to offsets and gathering.

File: magic ``FRVB0001``, then blocks
    u32 documents, u64 values, u64 control bytes, u64 data bytes,
    i64 document ids, u8 null flags, u64 values per document, control, data.
Files hold ascending ids (nulls first) and are rolled by size; the rank table lies beside them as Parquet.

Texts are tokenized whole, to the ids that the library gives for them; the string of a special token in a text is that
token.  White-space separated chunks are tokenized once per worker and remembered (bounded; never changes ids) if the
file's rules, tried out on probes, never cross white space; else every text goes to the library.  Null text is empty;
every document ends with the end id.  Ids must be integers; rows with equal ids lie next to each other.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import running_total
from .common import materialize, shared_path, shuffle_partitions, worker_memory
from .shards import MANIFEST, Shard, commit, manifest_batch, open_fs, spread

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
MAGIC = b"FRVB0001"
BLOCK_VALUES = 1 << 19
ROLL_BYTES = 64 << 20
_CACHE = 350_000  # chunks in a generation of a worker's memory
_HEAD = "<IQQQ"

_PROBES = ("Ab ab AB", "word, Word. WORD! mixed1 a-b it's", "\u00c9t\u00e9 \u00fcber, stra\u00dfe", "x<|y |z| <a> <|endoftext|>b", "1234 5.6 a_b", "  two  spaces\nline")

# length of each of the four values of a control byte
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) bytes of unsigned 32-bit values."""
    v = values.astype("<u4")
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    code = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    code[:len(v)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    four = v.view(np.uint8).reshape(-1, 4)
    data = four[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    end = np.cumsum(size, dtype=np.int64)
    at = end - size
    raw = np.frombuffer(data, np.uint8)
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if not len(more):
            break
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class WordTokenizer:
    """Ids of whole texts by the tokenizers library, chunk by chunk."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.words = Tokenizer.from_file(path)  # for words of letters, which hold no special string
        self.words.encode_special_tokens = True
        self.cutting = Tokenizer.from_file(path)
        special = [t.content for t in self.cutting.get_added_tokens_decoder().values() if t.special]
        self.mark = special[0] if special else None
        self.mark_id = self.cutting.token_to_id(self.mark) if special else -1
        self.kind = "<u2" if self.plain.get_vocab_size() <= 1 << 16 else "<u4"
        vocab = self.plain.get_vocab()
        self.closes = np.zeros(max(vocab.values(), default=0) + 1, bool)  # tokens that end a pre-token
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        lowered = self.plain.normalizer.normalize_str("Ab") if self.plain.normalizer is not None else "Ab"
        self.lower = lowered == "ab" and all(set("<>|") & set(t) for t in special)  # ASCII words of one spelling but for case are one chunk
        # what the chunks rely on, tried out: a file with other rules is left to the library text by text
        self.chunked = all(b"".join(self._chunks_of([t])[0]) == np.array(self.plain.encode(t, add_special_tokens=False).ids, self.kind).tobytes()
                           for t in _PROBES)

    def _letters(self, words: list[str]) -> bool:
        """Encode words of plain letters in one call: each is one pre-token, and its last token says so."""
        ids = np.array(self.words.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int64)
        end = np.flatnonzero(self.closes[ids]) + 1
        if len(end) != len(words) or end[-1] != len(ids):
            return False
        raw, lo, known = ids.astype(self.kind), 0, self.known
        for c, hi in zip(words, end.tolist()):
            known[c] = raw[lo:hi].tobytes()
            lo = hi
        return True

    def _learn(self, new: set[str]) -> None:
        known, kind = self.known, self.kind
        parts, base = {}, set()
        for c in new:  # letters with one closing mark are two pre-tokens; ASCII letters count lower-cased
            word, mark = c, None
            if not c.isalpha() and c[:-1].isalpha() and c[-1] in ".,;:!?":
                word, mark = c[:-1], c[-1]
            if self.lower and word.isascii() and not ("<" in word or ">" in word or "|" in word):
                word = word.lower()
            if mark is not None:
                parts[c] = (word, mark)
                base.add(mark)
            elif word is not c and word != c:
                parts[c] = (word,)
            base.add(word)
        base.difference_update(known)
        plain = [c for c in base if c.isalpha() and (c.isascii() or max(c) < "\u0250" and c.lower().isalpha())]
        if plain and self._letters(plain):
            base.difference_update(plain)
        odd = [c for c in base if self.mark is None or "<" in c or ">" in c or "|" in c]
        rest = [c for c in base if not ("<" in c or ">" in c or "|" in c)] if self.mark is not None else []
        if rest:  # one call: the special mark cuts the chunks apart before anything else is done
            ids = np.array(self.cutting.encode(self.mark.join(rest), add_special_tokens=False).ids, np.int64)
            cut = np.flatnonzero(ids == self.mark_id)
            raw = ids.astype(kind)
            lo = 0
            for c, hi in zip(rest, [*cut, len(ids)]):
                known[c] = raw[lo:hi].tobytes()
                lo = hi + 1
        for c in odd:
            known[c] = np.array(self.plain.encode(c, add_special_tokens=False).ids, kind).tobytes()
        for c, two in parts.items():
            known[c] = b"".join(map(known.__getitem__, two))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.chunked:
            return [np.array(e.ids, self.kind).tobytes() for e in self.plain.encode_batch(texts, add_special_tokens=False)]
        if len(self.known) > _CACHE:  # the generation before stays at hand: frequent chunks move over
            self.older, self.known = self.known, {"": b""}
        return [b"".join(c) for c in self._chunks_of(texts)]

    def _chunks_of(self, texts: list[str]):
        """The ids of every text's chunks."""
        chunks = [t.replace("\n", " ").split(" ") for t in texts]
        known, older = self.known, self.older
        new = set().union(*chunks).difference(known)
        if older:
            known.update((c, older[c]) for c in new & older.keys())
            new.difference_update(known)
        if new:
            self._learn(new)
        get = known.__getitem__
        return [map(get, cs) for cs in chunks]


def tokenizer(path: str) -> WordTokenizer:
    kept = worker_memory()
    if ("words", path) not in kept:
        kept["words", path] = WordTokenizer(path)
    return kept["words", path]


def encoded(df: DataFrame, text: str, id_col: str, path: str, end_id: int) -> DataFrame:
    """Written once: id, n, blob (ids, compressed), width."""
    def run(batches):
        import pyarrow as pa
        import zstandard
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            t = tokenizer(path)
            end = np.array([end_id], t.kind).tobytes()
            width = int(t.kind[-1])
            raw = []
            texts = b.column(1)
            for i in range(0, len(texts), 1000):  # few texts at a time as Python strings
                raw += [press.compress(x + end) for x in t.encode([s or "" for s in texts[i:i + 1000].to_pylist()])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary()),
                                              pa.array([width] * len(raw), pa.int32())], ["id", "blob", "width"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    return materialize(src.mapInArrow(run, "id long, blob binary, width int"), "token-blobs")


def _ids(blob: bytes, width: int, press) -> np.ndarray:
    return np.frombuffer(press.decompress(blob), f"<u{width}")


def frequencies(blobs: DataFrame) -> DataFrame:
    """(token, n): one partial row per token and batch of tasks."""
    def run(batches):
        import pyarrow as pa
        import zstandard
        press, total = zstandard.ZstdDecompressor(), np.zeros(0, np.int64)
        for b in batches:
            width = b.column(1).to_numpy()
            for k in range(0, b.num_rows, 500):  # documents counted at a time
                blobs_, widths = b.column(0)[k:k + 500].to_pylist(), width[k:k + 500]
                c = np.bincount(np.concatenate([_ids(x, w, press) for x, w in zip(blobs_, widths)]))
                if len(c) > len(total):
                    total = np.pad(total, (0, len(c) - len(total)))
                total[:len(c)] += c
        t = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(total[t])], ["token", "n"])

    return blobs.select("blob", "width").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def write_files(df: DataFrame, folder: str | None = None, text: str = "text", id_col: str = "doc_id",
                path: str | None = None, end_id: int = END_ID, roll: int = ROLL_BYTES) -> tuple[DataFrame, str]:
    """Tokenize and write; returns (manifest, folder).  The rank table is ``<folder>/_ranks``."""
    import public_tokenizers

    spark = df.sparkSession
    path = path or public_tokenizers.path(VOCABULARY)
    folder = folder or shared_path(spark, "token-files")
    blobs = encoded(df, text, id_col, path, end_id)
    # one row per token of the vocabulary: bounded by it, whatever the corpus
    found = sorted(((r["n"], r["token"]) for r in frequencies(blobs).collect()), key=lambda x: (-x[0], x[1]))
    order = np.array([t for _, t in found], np.int64)
    rank = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    spark.createDataFrame([(i, t, n) for i, (n, t) in enumerate(found)], "rank long, token long, n long").coalesce(1) \
        .write.mode("overwrite").parquet(f"{folder}/_ranks")

    def write(batches):
        import zstandard
        from pyspark import TaskContext
        press, part, seq, shard, held, rows = zstandard.ZstdDecompressor(), TaskContext.get().partitionId(), 0, None, [], []

        def flush():
            ids, nulls, counts = [], [], []
            for i, v in held:
                ids.append(0 if i is None else i)
                nulls.append(i is None)
                counts.append(len(v))
            values = rank[np.concatenate([v for _, v in held])]
            control, data = pack(values)
            head = struct.pack(_HEAD, len(held), len(values), len(control), len(data))
            shard.write(head + np.array(ids, "<i8").tobytes() + np.array(nulls, np.uint8).tobytes()
                        + np.array(counts, "<u8").tobytes() + control + data, len(held), len(values))
            held.clear()

        size = 0
        for b in batches:
            for i, x, w in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                if shard is None:
                    shard = Shard(folder, "tokens", part, seq, ".frvb")
                    shard.write(MAGIC)
                v = _ids(x.as_py(), w, press)
                held.append((i, v))
                size += len(v)
                if size >= BLOCK_VALUES:
                    flush()
                    size = 0
                    if shard.bytes >= roll:
                        rows.append(shard.close())
                        shard, seq = None, seq + 1
        if shard is not None:
            if held:
                flush()
            rows.append(shard.close())
        yield manifest_batch(rows)

    n = shuffle_partitions(spark)
    dealt = blobs.repartitionByRange(n, "id").sortWithinPartitions("id")
    return commit(dealt.select("id", "blob", "width").mapInArrow(write, MANIFEST), folder), folder


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: id, start, n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    order = np.array([r["token"] for r in spark.read.parquet(f"{folder}/_ranks").orderBy("rank").collect()], "<u4")
    placed = running_total(manifest.select("name", "part", "seq", "units"), [F.col("part"), F.col("seq")], "units", "before")

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for name, start in zip(b.column("name").to_pylist(), b.column("before").to_pylist()):
                fs, base = open_fs(folder)
                with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                    if f.read(len(MAGIC)) != MAGIC:
                        raise ValueError(f"{name}: not a token file")
                    while head := f.read(struct.calcsize(_HEAD)):
                        docs, n, nc, nd = struct.unpack(_HEAD, head)
                        ids = np.frombuffer(f.read(8 * docs), "<i8")
                        null = np.frombuffer(f.read(docs), np.uint8).astype(bool)
                        counts = np.frombuffer(f.read(8 * docs), "<u8").astype(np.int64)
                        values = order[unpack(f.read(nc), f.read(nd), n)]
                        cut = np.concatenate([[0], np.cumsum(counts)])
                        crc = [zlib.crc32(values[a:z].tobytes()) for a, z in zip(cut[:-1], cut[1:])]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids, mask=null), pa.array(start + cut[:-1]), pa.array(counts),
                             pa.array(crc, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])
                        start += int(cut[-1])

    return spread(placed, shuffle_partitions(spark)).mapInArrow(
        run, "id long, start long, n_tokens long, ids_crc32 long")


def token_file_round_trip(df: DataFrame, text: str = "text", id_col: str = "doc_id", **how) -> DataFrame:
    manifest, folder = write_files(df, None, text, id_col, **how)
    return read_files(manifest, folder).withColumnRenamed("id", id_col)
