"""SparkSession settings shared by the library, the tests and the bench.

The library never creates a session on a cluster by itself: callers pass one.
``get_spark`` is a convenience for local runs (tests, bench, smoke checks).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  AQE re-plans shuffles at
# runtime (coalesces small partitions, splits skewed join partitions); the
# session time zone is UTC so TIMESTAMP values compare as instants.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The only Arrow path is the MIME decoder: raw mails can weigh hundreds of
    # KB, so batches are capped (10 000 rows by default) to bound worker memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove checkpoint files once the checkpointed data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "alertlake") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("ALERTLAKE_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def materialize(df):
    """Reliable checkpoint (shared folder, survives executor loss) that cuts
    the lineage; the folder is ensured first (see ``ensure_checkpoint_dir``).

    The data is persisted while the checkpoint is written: a reliable
    checkpoint otherwise computes its plan twice (once for the eager count,
    once to write the files)."""
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def keep(df):
    """Keep a small, short-lineage derived table (per-key stats, per-domain
    routes, keyed rows) for reuse within a job: persisted memory-and-disk,
    filled by its first use.  A lost block is recomputed from its short,
    deterministic lineage; long lineages use ``materialize`` instead."""
    from pyspark import StorageLevel

    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.append(kept)
    return kept


_KEPT: list = []
_MEMOS: list[dict] = []


def memo() -> dict:
    """A per-run memo for driver-side scalars (cleared with ``release_kept``)."""
    m: dict = {}
    _MEMOS.append(m)
    return m


def release_kept() -> None:
    """Unpersist everything ``keep`` persisted and clear run memos (end of a
    run or micro-batch)."""
    while _KEPT:
        _KEPT.pop().unpersist()
    for m in _MEMOS:
        m.clear()


def spread(df):
    """Round-robin a scan that yields fewer splits than the cluster has cores.

    Text work is CPU-bound per row; a small file read as a handful of splits
    would leave cores idle.  Large inputs already have more splits than
    cores, so on a cluster this is a no-op."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must point at shared storage and is only read.
    A local-mode session without one (tests, bench) gets a fresh folder of
    its own; a non-local session without one is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: point it at shared storage")
    path = tempfile.mkdtemp(prefix="alertlake-ckpt-")
    sc.setCheckpointDir(path)
    return path
