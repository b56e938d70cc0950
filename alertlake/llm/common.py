"""What the operators of this package share: tables in the shared folder and
bounded slices of Arrow batches."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from alertlake.session import ensure_checkpoint_dir

#: Bytes of one column that a Python task looks at together.
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch that Spark hands to a Python worker.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches are bounded by bytes, so long texts do not pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names (see ``ensure_checkpoint_dir``)."""
    return spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)


def save(df: DataFrame, partition_by: str | None = None, codec: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` once as a table in the shared folder and read it back.

    Every later reader sees the same rows, also after executors were lost.  ``codec`` is the table's compression."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}"
    writer = df.write
    if codec:
        writer = writer.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    give_back()
    saved = spark.read.schema(df.schema).parquet(path)
    saved.saved_path = path
    return saved


def forget(df: DataFrame) -> None:
    """Remove a table made by ``save`` that nothing reads any more."""
    path = getattr(df, "saved_path", None)
    if path is None:
        return
    spark = df.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def slices(batches: Iterator[pa.RecordBatch], column: str,
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about ``most`` bytes in ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: workers are kept for later tasks, several to an executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """``batch`` with columns appended."""
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()],
                                      names=[*batch.schema.names, *columns])
