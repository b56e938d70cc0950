"""Ordered IDs, key maps and duplicate links.

The reference walks offers one by one with a running counter and a dict of
keys.  Here the same results come from a range shuffle (IDs) and a hash
shuffle on the dedup key (links), both distributed and skew-safe.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake.functions import text as T
from alertlake.operators.joins import sized_broadcast
from alertlake.operators.skew import join_back, with_group_stats
from alertlake.session import ensure_checkpoint_dir, keep, materialize

_LOCAL_BITS = 33  # monotonically_increasing_id(): partition id << 33 | row index


def assign_ordered_ids(df: DataFrame, order_cols: list[str | Column], out_col: str = "seq",
                       start: int | Column = 1, num_partitions: int | None = None) -> DataFrame:
    """Dense 1..N numbering in ``order_cols`` order, plus ``start - 1``.

    Equal to ``row_number() over (order by ...)`` without moving all rows to
    one partition: rows are range-partitioned and sorted within partitions,
    frozen by a reliable checkpoint (so both passes see the same rows even
    after an executor loss), the per-partition counts (one row per partition)
    are turned into prefix offsets, and each row adds its offset to its index
    inside the partition.  ``order_cols`` should be unique for a stable result.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_mid", F.monotonically_increasing_id())
              .transform(materialize))
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    # One count per partition (bounded by the partition count, not the data):
    # prefix offsets become a literal array indexed by partition id.
    counts = {r["_pid"]: r["_n"] for r in
              ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n")).collect()}
    offsets, acc = [], 0
    for p in range(max(counts, default=-1) + 1):
        offsets.append(acc)
        acc += counts.get(p, 0)
    off_arr = F.array(*[F.lit(o).cast("bigint") for o in offsets]) if offsets else F.array(F.lit(0).cast("bigint"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (ranged.withColumn(out_col, (start_col - 1 + F.element_at(off_arr, (pid + 1).cast("int"))
                                        + local + 1).cast("bigint"))
            .drop("_mid"))


def max_offer_number(archive: DataFrame | None, id_col: str = "ID") -> Column:
    """A1: greatest ``E<n>`` number over an archive, 0 when there is none (lenient parse)."""
    return F.coalesce(F.max(T.parse_offer_id_lenient(F.col(id_col))), F.lit(0)).cast("bigint")


def key_map(archive: DataFrame, key_col: str = "Cle_dedup", id_col: str = "ID",
            order_col: str = "ord", canonical: str = "last") -> DataFrame:
    """A3: one (key, ID) per dedup key of the archive.

    ``canonical="last"`` keeps the last archived row per key (what reloading
    the archive row by row yields); ``"first"`` keeps the first occurrence.
    Empty keys are ignored.  Partial aggregation: skew-safe.
    """
    pick = F.max_by if canonical == "last" else F.min_by
    return (archive.where(F.col(key_col).isNotNull() & (F.col(key_col) != ""))
            .groupBy(key_col)
            .agg(pick(F.col(id_col), F.col(order_col)).alias("_arch_id")))


def link_duplicates(batch: DataFrame, key_col: str = "Cle_dedup", id_col: str = "ID",
                    order_col: str = "ord", archive_map: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
                    out_col: str = "Doublon_ID", archive: DataFrame | None = None,
                    canonical: str = "last", archive_order_col: str = "ord") -> DataFrame:
    """W2 + J6: the first row of a key gets ``""``; later rows of that key in the
    batch get the first row's ID; a key already archived links every batch
    row to the archived ID.

    The archive is given either as a ready map (``archive_map``: ``key_col``,
    ``_arch_id``; also a function that makes it from the batch's keys) or as rows (``archive``: ``key_col``, ``id_col``,
    ``archive_order_col``).  Rows are first semi-joined with the batch's keys (a
    broadcast of the batch's distinct keys when small enough), so only archive
    rows sharing a key with the batch are aggregated: per-run work follows the
    batch, not the whole history."""
    stats = batch.groupBy(key_col).agg(
        F.count(F.lit(1)).alias("_grp_n"),
        F.min_by(F.col(id_col), F.col(order_col)).alias("_first_id"))
    if archive is not None:
        stats = keep(stats)  # read by the size check, the semi join and the join
        keys, _ = sized_broadcast(stats.select(key_col))
        archive_map = key_map(archive.join(keys, key_col, "left_semi"), key_col, id_col, archive_order_col,
                              canonical)
    if callable(archive_map):
        stats = keep(stats)  # read by the lookup and the join
        archive_map = archive_map(stats.select(key_col).where(F.col(key_col).isNotNull()))
    if archive_map is not None:
        stats = stats.join(archive_map, key_col, "left")
    else:
        stats = stats.withColumn("_arch_id", F.lit(None).cast("string"))
    out = join_back(batch, stats, [key_col], "_grp_n")
    link = F.coalesce(
        F.col("_arch_id"),
        F.when(F.col(id_col) != F.col("_first_id"), F.col("_first_id")),
        F.lit(""))
    return out.withColumn(out_col, link).drop("_grp_n", "_first_id", "_arch_id")


def duplicate_count(df: DataFrame, key_col: str, out_col: str = "dup_count") -> DataFrame:
    """Rows sharing the key (``count(*) over (partition by key)``), skew-safe."""
    return (with_group_stats(df, [key_col], [], count_col="_grp_n")
            .withColumn(out_col, F.col("_grp_n").cast("bigint")).drop("_grp_n"))


def first_per_key(df: DataFrame, key_cols: list[str], order_col: str,
                  out_col: str = "is_first") -> DataFrame:
    """Flag the first row (by ``order_col``) of each key, skew-safe."""
    first = with_group_stats(df, key_cols, [F.min(order_col).alias("_grp_first")], count_col="_grp_n")
    return first.withColumn(out_col, F.col(order_col) == F.col("_grp_first")).drop("_grp_n", "_grp_first")


def rank_within_group(df: DataFrame, key_cols: list[str], order_cols: list[str],
                      out_col: str = "rank") -> DataFrame:
    """``row_number() over (partition by keys order by ...)`` without sending a
    hot group to one task: a global ordered numbering (range shuffle splits
    big groups over many partitions) minus the group's first number."""
    seq = assign_ordered_ids(df, key_cols + order_cols, out_col="_gseq")
    first = with_group_stats(seq, key_cols, [F.min("_gseq").alias("_gfirst")], count_col="_grp_n")
    return (first.withColumn(out_col, (F.col("_gseq") - F.col("_gfirst") + 1).cast("bigint"))
            .drop("_gseq", "_gfirst", "_grp_n"))
