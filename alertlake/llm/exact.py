"""Exact de-duplication with a two-pass Bloom filter.

Pass 1 marks, for the hash of every text, a few bits of a Bloom filter that
remembers whether a bit was marked once or again.  Pass 2 looks each hash up: a
hash all of whose bits were marked again may be repeated.  Only those rows are
shuffled and compared by their full SHA-256; all others pass straight through.

The filter grows with the table (``BITS_PER_ROW`` bits a row).  It is built in
blocks, one task for each, and read by all tasks; where it would exceed
``FILTER_BYTES`` the hashes are dealt into slices by some of their bits, and the
slices are treated one after another, each with a filter within that bound.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.llm.common import bound_batches, save

BITS_PER_ROW = 16
PROBES = 4
#: The largest filter that is sent to every task.
FILTER_BYTES = 64 << 20
_BLOCK_BITS = 20  # a block of the filter holds 2**20 bits


def _lanes(digests: pa.Array) -> np.ndarray:
    """Hex digests as rows of four unsigned 64-bit numbers."""
    raw = bytes.fromhex("".join(digests.to_pylist()))
    return np.frombuffer(raw, dtype="<u8").reshape(-1, 4)


def _positions(lanes: np.ndarray, bits: int) -> np.ndarray:
    return lanes[:, :PROBES] & np.uint64(bits - 1)


def _marks(bits: int):
    """Pass 1, map side: the marked positions of a partition, by block; those
    marked by several rows of the partition are listed twice, never more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_positions(_lanes(b.column(0)), bits).ravel() for b in batches if b.num_rows]
        if not found:
            return
        at, times = np.unique(np.concatenate(found), return_counts=True)
        at = np.sort(np.concatenate([at, at[times > 1]]))
        block = (at >> np.uint64(_BLOCK_BITS)).astype(np.int64)
        inside = (at & np.uint64((1 << _BLOCK_BITS) - 1)).astype("<u4")
        names, first = np.unique(block, return_index=True)
        parts = np.split(inside, first[1:])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([p.tobytes() for p in parts], pa.binary())], names=["block", "marks"])

    return run


def _merge(table: pa.Table) -> pa.Table:
    """Pass 1, reduce side: the bits of one block that were marked more than once."""
    times = np.zeros(1 << _BLOCK_BITS, dtype=np.uint32)
    for marks in table.column("marks"):
        times += np.bincount(np.frombuffer(marks.as_buffer(), dtype="<u4"),
                             minlength=len(times)).astype(np.uint32)
    again = zlib.compress(np.packbits(times > 1, bitorder="little").tobytes(), 1)
    return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int64()),
                     "bits": pa.array([again], pa.binary())})


def _repeat_filter(digests: DataFrame, rows: int):
    """A broadcast bitmap of the positions marked more than once, and its size in bits."""
    bits = 1 << max(_BLOCK_BITS, int(rows * BITS_PER_ROW - 1).bit_length())
    blocks = (digests.mapInArrow(_marks(bits), "block long, marks binary")
              .groupBy("block").applyInArrow(_merge, "block long, bits binary"))
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    span = (1 << _BLOCK_BITS) // 8
    # At most FILTER_BYTES altogether, whatever the number of rows (see `slices` below).
    for row in blocks.toLocalIterator():
        bitmap[row.block * span:(row.block + 1) * span] = np.frombuffer(zlib.decompress(row.bits), np.uint8)
    return digests.sparkSession.sparkContext.broadcast(bitmap), bits


def _may_repeat(bitmap, bits: int, digest: str):
    """Pass 2 as a column: could this digest occur more than once?"""

    @F.arrow_udf(T.BooleanType())
    def lookup(digests: pa.Array) -> pa.Array:
        if not len(digests):
            return pa.array([], pa.bool_())
        at = _positions(_lanes(digests), bits)
        hit = (bitmap.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
        return pa.array(hit.all(axis=1))

    return lookup(F.col(digest))


def _slices(rows: int, filter_bytes: int) -> int:
    """How many slices keep a filter within ``filter_bytes`` (a power of two)."""
    need = -(-rows * BITS_PER_ROW * 2 // (8 * filter_bytes))
    return 1 << max(0, int(need - 1).bit_length())


def text_digest(text: str) -> F.Column:
    """SHA-256 of a text's UTF-8 bytes, as lowercase hex; a null counts as empty."""
    return F.sha2(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8"), 256)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Rows are equal when their texts are identical; null counts as empty.  Of equal
    texts the row with the largest id stays; of repeated rows with that same id
    exactly one stays.  Null ids sort below all others.  Other columns are not
    read, whatever their names; an empty table gives an empty result."""
    spark = docs.sparkSession
    bound_batches(spark)
    hashed = docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("text_sha256"))
    hashed = hashed.withColumn("row_id", F.monotonically_increasing_id())
    # The slice comes from bits that no probe uses at that filter size.
    hashed = hashed.withColumn("slice", F.conv(F.substring("text_sha256", 61, 4), 16, 10).cast("int"))
    hashed = save(hashed)
    rows = hashed.count()
    parts = []
    n = _slices(rows, filter_bytes)
    for k in range(n):
        part = hashed.where(F.col("slice") % n == k) if n > 1 else hashed
        bitmap, bits = _repeat_filter(part.select("text_sha256"), -(-rows // n))
        flagged = save(part.drop("slice").withColumn("again", _may_repeat(bitmap, bits, "text_sha256")))
        bitmap.unpersist()
        parts.append(_resolve(flagged))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumnRenamed("doc_id", id_col)


def _resolve(flagged: DataFrame) -> DataFrame:
    """Rows marked ``again`` are grouped by their digest; the rest stay as they are."""
    alone = flagged.where(~F.col("again")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    rows = flagged.where(F.col("again"))
    # One row per digest and map task is shuffled, however large a group is.
    groups = save(rows.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "row_id")).alias("last"),
                                                  F.count(F.lit(1)).alias("group_size")))
    # Only ids and digests are joined.  The groups are a table of their own, so that nothing but the join asks
    # for its partitions and AQE may split that of a hot digest.
    joined = rows.join(groups, "text_sha256").select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("last.row_id")).alias("kept"), "text_sha256")
    return alone.unionByName(joined)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``docs`` without exact copies, with all columns of ``docs``.

    The rows whose hash the filter has not seen again are passed on where they
    were read.  Of the others, one row per text and map task is shuffled: the
    one with the largest id (ties: the greatest row hash), which is then found
    among all tasks."""
    spark = docs.sparkSession
    bound_batches(spark)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    hashed = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), text_digest(text_col).alias("digest"))
    digests = save(hashed.select("digest"))
    rows = digests.count()
    n = _slices(rows, filter_bytes)
    slice_of = F.conv(F.substring("digest", 61, 4), 16, 10).cast("int") % n
    kept = None
    for k in range(n):
        bitmap, bits = _repeat_filter(digests.where(slice_of == k), -(-rows // n))
        flagged = hashed.where(slice_of == k).withColumn("again", _may_repeat(bitmap, bits, "digest"))
        alone = flagged.where(~F.col("again")).select("row.*")
        tie = F.struct("id", F.xxhash64(*[F.col(f"row.`{c}`") for c in docs.columns if c != text_col]))
        one = (flagged.where(F.col("again")).groupBy("digest")
               .agg(F.max_by("row", tie).alias("row")).select("row.*"))
        both = alone.unionByName(one)
        kept = both if kept is None else kept.unionByName(both)
    return kept


def brute_force(rows: list[tuple]) -> list[tuple]:
    """What ``exact_duplicates`` returns for (id, text) rows with distinct ids."""
    groups: dict[str, list] = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    return [(i, max(groups[text or ""]), len(groups[text or ""]), i == max(groups[text or ""]),
             hashlib.sha256((text or "").encode()).hexdigest()) for i, text in rows]
