"""Writing shard files from tasks: temporary names, a manifest, a commit.

A task writes under a name of its own attempt and reports it; the reports of the attempts that succeeded are
the manifest (a Parquet table).  The commit, a Spark job over the manifest, moves each file to its final name
and may be repeated; files of lost attempts are in no manifest and go with the temporary folder.  Readers
follow the manifest.  Folders are under the shared checkpoint folder unless the caller names another; paths
are opened through ``pyarrow.fs``, so any store that it reaches will do.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MANIFEST = "name string, temp string, part int, seq int, items long, units long, bytes long, sha256 string"


def open_fs(uri: str):
    from pyarrow import fs
    if uri.startswith(("/", "file:")):  # Hadoop writes file:/a for file:///a
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


class Shard:
    """One file being written by a task attempt."""

    def __init__(self, folder: str, stem: str, part: int, seq: int, suffix: str):
        self.fs, base = open_fs(folder)
        self.name = f"{stem}-{part:06d}-{seq:05d}{suffix}"
        self.temp = f"_tmp/{self.name}.{uuid.uuid4().hex}"
        self.part, self.seq = part, seq
        self.fs.create_dir(f"{base}/_tmp", recursive=True)
        self.out = self.fs.open_output_stream(f"{base}/{self.temp}", compression=None)
        self.items = self.units = self.bytes = 0
        self.sha = hashlib.sha256()

    def write(self, data: bytes, items: int = 0, units: int = 0) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)
        self.items += items
        self.units += units

    def close(self) -> tuple:
        self.out.close()
        return (self.name, self.temp, self.part, self.seq, self.items, self.units, self.bytes, self.sha.hexdigest())


def manifest_batch(rows: list[tuple]):
    import pyarrow as pa
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = [f.split()[0] for f in MANIFEST.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def commit(reports: DataFrame, folder: str) -> DataFrame:
    """Write the manifest, move the files to their final names; returns the manifest."""
    spark = reports.sparkSession
    reports.write.mode("overwrite").parquet(f"{folder}/_manifest")
    manifest = spark.read.parquet(f"{folder}/_manifest")

    def move(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs
        for b in batches:
            fs, base = open_fs(folder)
            for name, temp in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if fs.get_file_info(f"{base}/{temp}").type != pafs.FileType.NotFound:
                    fs.move(f"{base}/{temp}", f"{base}/{name}")
                elif fs.get_file_info(f"{base}/{name}").type == pafs.FileType.NotFound:
                    raise FileNotFoundError(f"{name}: neither the temporary nor the final file is there")
            yield pa.RecordBatch.from_arrays([b.column(0)], ["name"])

    moved = manifest.select("name", "temp").mapInArrow(move, "name string").agg(F.count(F.lit(1)).alias("n")).first()["n"]
    fs, base = open_fs(folder)
    from pyarrow import fs as pafs
    if moved and fs.get_file_info(f"{base}/_tmp").type == pafs.FileType.Directory:
        fs.delete_dir(f"{base}/_tmp")
    return manifest


def spread(manifest: DataFrame, n: int) -> DataFrame:
    """Manifest rows dealt over tasks, by name."""
    return manifest.repartition(max(1, n), "name")
