"""Session construction and lineage cutting.

The library never assumes a particular cluster: it reads what the session
already carries.  ``build_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins from measured sizes
# (runtime broadcast demotion), splits skewed join partitions and coalesces
# small shuffle outputs.  None of them changes a result.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_WRITTEN: list[str] = []  # folders of this session's intermediates


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "reviewspark", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g")))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared lineage folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    *and* the master is local (tests, bench) is a scratch folder created; on a
    cluster a machine-local folder would be wrong, so that case raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
        current = tempfile.mkdtemp(prefix="reviewspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not (sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None):
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint folder and read it back.

    Used for fitted artefacts that are re-read by several later stages
    (vocabularies, idf tables, encoded corpora): one pass to compute, lineage
    cut, and the files survive executor loss.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    freed_shuffles(spark)
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append(path)
    return spark.read.parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (for written tables)."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


BATCH_BYTES = "8m"


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold ``BATCH_BYTES`` at most, unless the session names a size itself.

    Batches are counted in rows by default, so a batch of long texts can take hundreds of megabytes in a worker and as
    much again outside the heap.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, BATCH_BYTES)


def freed_shuffles(spark: SparkSession) -> None:
    """Let a finished query's shuffle files go at once, unless the session names the setting itself.

    Otherwise they stay until the driver happens to collect its garbage, and a solver of many jobs fills the disk.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, "true")


def release(df: DataFrame) -> None:
    """Delete the table that ``materialize`` or ``shared_path`` made and ``df`` reads, which nothing reads any more."""
    spark = df.sparkSession
    names = {os.path.dirname(f) for f in df.inputFiles()}
    for path in [p for p in _WRITTEN if any(n.rstrip("/").endswith(p.rsplit("/", 1)[1]) for n in names)]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        _WRITTEN.remove(path)


def release_intermediates(spark: SparkSession) -> int:
    """Delete every table that ``materialize`` and ``shared_path`` made so far; returns their number.

    For callers that are done with the results that read them (the bench after each query, a service between
    requests): a lazy result must be written or collected first.
    """
    n = 0
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n
