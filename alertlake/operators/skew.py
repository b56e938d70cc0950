"""Skew-safe per-key statistics joined back onto the rows they came from.

A window ``over (partition by key)`` sends every row of a key to one task; a
placeholder key (empty company/city/title) can hold a third of all rows.  The
pattern used instead everywhere in this package:

1. ``groupBy(key).agg(...)``: partial (map-side) aggregation, so a hot key
   costs one small record per map task in the shuffle;
2. join the per-key result back.  The statistics rows of the hottest keys (a list
   of at most ``max_hot``, so bounded by construction) are broadcast: rows of a
   hot key stay where they are.  All other rows are joined by shuffle, where
   AQE still splits a partition that turns out large.

Keys are compared null-safely: rows with a NULL key form a group like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from alertlake.session import keep

DEFAULT_HOT_ROWS = 1_000_000
DEFAULT_MAX_HOT = 1_000


def hot_keys(stats: DataFrame, keys: list[str], count_col: str,
             hot_rows: int = DEFAULT_HOT_ROWS, max_hot: int = DEFAULT_MAX_HOT) -> DataFrame:
    """At most ``max_hot`` keys whose group has at least ``hot_rows`` rows."""
    return (stats.where(F.col(count_col) >= hot_rows)
            .orderBy(F.col(count_col).desc())
            .limit(max_hot)
            .select(*keys, F.lit(True).alias("_hot")))


def _joined(rows: DataFrame, stats: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``rows JOIN stats`` on null-safe equality of the keys, with one copy of them."""
    renamed = stats.select(*[F.col(k).alias(f"_s_{k}") if k in keys else F.col(k) for k in stats.columns])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    return rows.join(renamed, same, how).drop(*[f"_s_{k}" for k in keys])


def join_back(rows: DataFrame, stats: DataFrame, keys: list[str], count_col: str,
              how: str = "left", hot_rows: int | None = None, max_hot: int | None = None) -> DataFrame:
    """``rows JOIN stats USING (keys)``, null-safe, without shuffling the rows of hot keys.

    ``stats`` must hold one row per key and a row-count column ``count_col`` (used to
    find hot keys).  Without a hot key the plan is a plain join."""
    hot_rows = DEFAULT_HOT_ROWS if hot_rows is None else hot_rows
    max_hot = DEFAULT_MAX_HOT if max_hot is None else max_hot
    # One row per key, read twice (hot-key list and the join): kept once.
    stats = keep(stats)
    hot = keep(hot_keys(stats, keys, count_col, hot_rows, max_hot))
    if hot.isEmpty():
        return _joined(rows, stats, keys, how)
    marked = _joined(rows, F.broadcast(hot), keys, "left")
    is_hot = F.col("_hot").isNotNull()
    hot_stats = _joined(stats, F.broadcast(hot), keys, "inner").drop("_hot")
    warm = _joined(marked.where(is_hot).drop("_hot"), F.broadcast(hot_stats), keys, how)
    cold = _joined(marked.where(~is_hot).drop("_hot"), stats, keys, how)
    return warm.unionByName(cold)


def with_group_stats(rows: DataFrame, keys: list[str], aggs: list, count_col: str = "_grp_n",
                     **kw) -> DataFrame:
    """Attach per-key aggregates to every row, skew-safe (see module doc)."""
    stats = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col), *aggs)
    return join_back(rows, stats, keys, count_col, **kw)
