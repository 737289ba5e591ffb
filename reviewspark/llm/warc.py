"""Deterministic sharded WARC writer and reader.

Records are range-sorted by page id and cut into about ``SHARDS`` shards of equal payload (none under
``LEAST_BYTES`` or over ``MOST_BYTES``) by one global running total over the narrow (id, bytes) rows, so the cuts
do not depend on Spark's sampling or partition count.
Each shard is sorted and written by one task as gzip members (one per record, fixed time stamps, record ids
derived from page id and digest), and rolled to a new file by compressed size: equal input gives equal files.
Headers and digests are made anew from the payload.  Files get temporary names, a manifest and a commit
(``shards``).  The shard cuts, one number a shard, travel with the tasks (100,000 numbers at 100 TB).

Of records with equal payloads (SHA-1 and length) of at least ``min_payload`` bytes the one with the largest
page id is the response and the others are revisits that refer to it; smaller ones are all responses.  Groups
are map-side combined; a Bloom filter marks the rows whose payload may repeat, and only those are joined with the
groups (a join that AQE can split, for a payload that a third of all pages share).

Null html is an empty payload.  Null ids sort first and never win over others; rows with equal ids are sorted
by payload digest, and each is written.  Of repeated rows (same id, same payload) the first is the response, if
their id is the largest, and the others refer to that same id.  Empty table: no files, no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import running_total
from .common import materialize, shared_path, shuffle_partitions
from .exact_dedup import RepeatFilter
from .shards import MANIFEST, Shard, commit, manifest_batch, open_fs, spread

SHARDS = 4096                                  # shards that a corpus is cut into ...
LEAST_BYTES, MOST_BYTES = 1 << 20, 1 << 30     # ... as far as each holds this much payload
ROLL_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
_READ = 1 << 20


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{kind}')}>"


def record(page_id, url: str | None, digest: str, size: int, payload: bytes | None = None, refers=None,
           date: str = DATE) -> bytes:
    """One WARC/1.1 record; without ``payload`` a revisit (HTTP headers only) of the page ``refers``."""
    kind = "revisit" if payload is None else "response"
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
             + (payload or b""))
    uri = "".join(c if c > " " else "%%%02X" % ord(c) for c in (url or f"urn:page:{page_id}"))
    shown = lambda x: "" if x is None else x
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest, kind)}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Block-Digest: sha1:{sha1_base32(block)}", f"Page-ID: {shown(page_id)}", f"Payload-Length: {size}"]
    if payload is None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers, digest, 'response')}", f"Refers-To-Page-ID: {shown(refers)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    """A gzip member without time or name: equal data, equal bytes."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _body(html: str):
    return F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8")


def _narrow(pages: DataFrame, html: str, id_col: str) -> DataFrame:
    """(id, digest, bytes), written once; native."""
    return materialize(pages.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha1(_body(html))).alias("digest"),
                                    F.octet_length(_body(html)).cast("long").alias("bytes")), "warc-digests")


def _cuts(narrow: DataFrame, shard_bytes: int | None) -> np.ndarray:
    """First ids of the shards after the first: ``SHARDS`` numbers, or one per ``MOST_BYTES`` of payload."""
    sized = narrow.select("id", "digest", (F.col("bytes") + 512).alias("size"))
    total = sized.agg(F.sum("size")).first()[0] or 0
    per = shard_bytes or min(max(-(-total // SHARDS), LEAST_BYTES), MOST_BYTES)
    placed = running_total(sized, [F.col("id"), F.col("digest"), F.col("size")], "size", "before")
    first = placed.groupBy(F.floor(F.col("before") / per).alias("shard")).agg(F.min("id").alias("id")).collect()
    return np.array(sorted({r["id"] for r in first if r["shard"] > 0 and r["id"] is not None}), np.int64)


def write_warc(pages: DataFrame, folder: str | None = None, html: str = "html", url: str = "url",
               id_col: str = "page_id", min_payload: int = 0, shard_bytes: int | None = None,
               roll_bytes: int = ROLL_BYTES) -> tuple[DataFrame, str]:
    """Write every row as a record; returns (manifest, folder)."""
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    narrow = _narrow(pages, html, id_col)
    same = ["digest", "bytes"]
    groups = materialize(
        narrow.where(F.col("bytes") >= min_payload).groupBy(*same)
        .agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(F.xxhash64("digest").alias("key"), F.col("digest").alias("g_digest"), F.col("bytes").alias("g_bytes"), "last"),
        "warc-groups")
    flt = RepeatFilter.build(groups, "key", max(1, groups.count()), least=1)
    cuts = _cuts(narrow, shard_bytes)

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url).alias("url"), _body(html).alias("body"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("body"))).withColumn("bytes", F.octet_length("body").cast("long"))
    rows = flt.mark(rows, F.xxhash64("digest"), "maybe")
    cols = ["id", "url", "body", *same]
    alone = rows.where(~F.col("maybe")).select(*cols, F.lit(None).cast("long").alias("refers"), F.lit(False).alias("repeats"))
    some = rows.where("maybe").join(groups, (F.col("digest") == F.col("g_digest")) & (F.col("bytes") == F.col("g_bytes")), "left")
    other = F.col("g_digest").isNotNull() & ~F.col("id").eqNullSafe(F.col("last"))
    some = some.select("id", "url", F.when(~other, F.col("body")).alias("body"), *same,  # a revisit's payload stays behind
                       F.when(other, F.col("last")).alias("refers"), F.col("g_digest").isNotNull().alias("repeats"))

    def deal(batches):
        import pyarrow as pa
        for b in batches:
            ids = b.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.searchsorted(cuts, ids, "right").astype(np.int32))],
                                             [*b.schema.names, "shard"])

    dealt = alone.unionByName(some).mapInArrow(
        deal, "id long, url string, body binary, digest binary, bytes long, refers long, repeats boolean, shard int")

    def write(batches):
        import pyarrow as pa
        shard, seq, part, last, done = None, 0, None, None, []
        for b in batches:
            for k in range(0, b.num_rows, 200):  # few payloads at a time as Python objects
                for i, u, body, digest, size, refers, repeats, s in zip(*(c.to_pylist() for c in b.slice(k, 200).columns)):
                    if s != part:
                        if shard is not None:
                            done.append(shard.close())
                        shard, seq, part = None, 0, s
                    if shard is None:
                        shard = Shard(folder, "warc", part, seq, ".warc.gz")
                    if body is not None and repeats:
                        if last == (i, digest):  # the same row once more
                            body, refers = None, i
                        last = (i, digest)
                    shown = base64.b32encode(digest).decode()
                    if body is not None and sha1_base32(body) != shown:
                        raise ValueError(f"page {i}: the payload changed on its way")
                    shard.write(member(record(i, u, shown, size, body, refers)), 1, size)
                    if shard.bytes >= roll_bytes:
                        done.append(shard.close())
                        shard, seq = None, seq + 1
        if shard is not None:
            done.append(shard.close())
        yield manifest_batch(done) if done else pa.RecordBatch.from_pylist([], manifest_batch([]).schema)

    sorted_ = dealt.repartition(shuffle_partitions(spark), "shard").sortWithinPartitions("shard", "id", "digest", "url")
    return commit(sorted_.mapInArrow(write, MANIFEST), folder), folder


def members(stream):
    """The gzip members of a stream, one at a time."""
    held = stream.read(_READ)
    while held:
        d, out = zlib.decompressobj(31), []
        while not d.eof:
            if not held:
                held = stream.read(_READ)
                if not held:
                    raise EOFError("a record is cut off")
            out.append(d.decompress(held))
            held = d.unused_data
        yield b"".join(out)
        held = held or stream.read(_READ)


def parse(data: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of a record, checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(h["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or f"sha1:{sha1_base32(block)}" != h["WARC-Block-Digest"]:
        raise ValueError(f"record {h['WARC-Record-ID']} is damaged")
    number = lambda x: int(x) if x else None
    digest, size, payload = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["Payload-Length"]), None
    if h["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        size, found = len(payload), sha1_base32(payload)
        if found != digest:
            raise ValueError(f"record {h['WARC-Record-ID']}: payload and digest differ")
    return (number(h["Page-ID"]), size, digest, h["WARC-Type"], number(h.get("Refers-To-Page-ID", "")), payload)


def read_warc(manifest: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to (and payload)."""
    import pyarrow as pa

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    n = 6 if payloads else 5

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for name in b.column("name").to_pylist():
                fs, base = open_fs(folder)
                rows = []
                with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                    for data in members(f):
                        rows.append(parse(data)[:n])
                        if len(rows) == 1000:
                            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(n)], names[:n])
                            rows = []
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(n)], names[:n])

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return spread(manifest.select("name"), shuffle_partitions(manifest.sparkSession)).mapInArrow(
        run, schema + ", payload binary" * payloads)


def warc_round_trip(pages: DataFrame, **how) -> DataFrame:
    return read_warc(*write_warc(pages, **how))
