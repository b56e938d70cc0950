"""Sharding by extendible hashing, with DataFrame functions only.

A directory cell is a prefix of the key's hash bits.  A cell over the byte limit
splits on the next bit; a cell within it is a shard.  Cells are sized from the
table of (hash, bytes) alone, ``ROUND_BITS`` bits a round: one aggregation gives
the bytes of all finer cells, from which those of their ancestors are summed, so
a round decides up to ``ROUND_BITS`` splits.  Only rows of cells that are still
too large take part in the next round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlake.llm.common import save

#: Hash bits in all: 15 hex digits of an MD5, so they fit a signed 64-bit number.
HASH_BITS = 60
ROUND_BITS = 12
SHARD_BYTES = 8 << 20


def _prefix(bits, depth) -> F.Column:
    """The first ``depth`` of ``HASH_BITS`` hash bits, as a string of 0 and 1."""
    return F.substring(F.lpad(F.bin(bits), HASH_BITS, "0"), 1, depth)


def hash_bits(key: F.Column) -> F.Column:
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def _round(rows: DataFrame, depth: int, limit: int) -> DataFrame:
    """The directory of cells of ``depth`` to ``depth + ROUND_BITS`` bits: (cell, shard,
    shard_bytes, shard_rows, open), one row per cell of the finest depth.  ``shard`` is
    the shallowest ancestor that fits; where even the finest cell does not, ``open``."""
    fine = rows.groupBy(_prefix(F.col("bits"), depth + ROUND_BITS).alias("cell")).agg(
        F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    depths = F.sequence(F.lit(depth), F.lit(depth + ROUND_BITS))
    up = fine.select("cell", "bytes", "rows", F.explode(depths).alias("depth"))
    up = up.withColumn("shard", F.expr("substring(cell, 1, depth)"))
    sizes = up.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
    fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1)
    best = up.join(sizes, "shard").groupBy("cell").agg(
        F.min_by(F.struct("shard", "shard_bytes", "shard_rows"),
                 F.when(fits, F.col("depth")).otherwise(F.col("depth") + HASH_BITS)).alias("first"),
        F.max(fits).alias("done"))
    return best.select("cell", "first.*", (~F.col("done")).alias("open"))


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  limit: int = SHARD_BYTES, round_bits: int | None = None) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes`` (UTF-8 bytes of the text), ``shard``
    (hash-prefix bits; empty: the whole table), ``shard_bytes`` and ``shard_rows``.

    Each shard holds at most ``limit`` bytes.  The one exception is a single text above
    the limit: it gets a shard of its own.  A null text has 0 bytes and a null id hashes
    like the empty string.  Rows that share an id share all hash bits; if together they
    exceed the limit, they are told apart by a second hash, of the row's place in the
    written table, whose bits follow after ``~``.  Other columns are not read."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("bytes"),
        hash_bits(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("bits"))
    rows = save(rows.withColumn("place", F.monotonically_increasing_id()))
    done, rest = _split(rows, limit)
    if rest is not None:
        again = rest.withColumn("same", F.col("bits")).withColumn(
            "bits", hash_bits(F.concat_ws(":", "bits", "place")))
        done = done.unionByName(_split_each(again, limit))
    return done.select(F.col("doc_id").alias(id_col), F.col("bytes").alias("n_bytes"),
                       "shard", "shard_bytes", "shard_rows")


def _split(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows with their shard, and those whose cells are too large with all bits used."""
    done, depth = None, 0
    while True:
        cells = save(_round(rows, depth, limit))
        placed = rows.withColumn("cell", _prefix(F.col("bits"), depth + ROUND_BITS)).join(cells, "cell")
        shut = placed.where(~F.col("open")).drop("open", "cell")
        done = shut if done is None else done.unionByName(shut)
        if cells.where("open").isEmpty():
            return done, None
        rows = save(placed.where("open").select("doc_id", "bytes", "bits", "place"))
        depth += ROUND_BITS
        if depth + ROUND_BITS > HASH_BITS:
            return done, rows


def _split_each(rows: DataFrame, limit: int) -> DataFrame:
    """The same for rows of equal keys: each key's rows are split by the second hash."""
    done, depth = None, 0
    name = F.concat(_prefix(F.col("same"), HASH_BITS), F.lit("~"))
    while True:
        fine = rows.groupBy("same", _prefix(F.col("bits"), depth + ROUND_BITS).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        up = fine.withColumn("depth", F.explode(F.sequence(F.lit(depth), F.lit(depth + ROUND_BITS))))
        up = up.withColumn("shard", F.expr("substring(cell, 1, depth)"))
        sizes = up.groupBy("same", "shard").agg(F.sum("bytes").alias("shard_bytes"),
                                                F.sum("rows").alias("shard_rows"))
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1)
        best = up.join(sizes, ["same", "shard"]).groupBy("same", "cell").agg(
            F.min_by(F.struct("shard", "shard_bytes", "shard_rows"),
                     F.when(fits, F.col("depth")).otherwise(F.col("depth") + HASH_BITS)).alias("first"),
            F.max(fits).alias("done"))
        cells = save(best.select("same", "cell", "first.*", (~F.col("done")).alias("open")))
        placed = rows.withColumn("cell", _prefix(F.col("bits"), depth + ROUND_BITS)).join(cells, ["same", "cell"])
        shut = placed.where(~F.col("open")).withColumn("shard", F.concat(name, "shard")).drop("same", "open", "cell")
        done = shut if done is None else done.unionByName(shut)
        if cells.where("open").isEmpty() or depth + 2 * ROUND_BITS > HASH_BITS:
            return done
        rows = save(placed.where("open").select("doc_id", "bytes", "bits", "place", "same"))
        depth += ROUND_BITS


def oracle(limit: int) -> str:
    """The same in DuckDB SQL, for distinct ids: the shallowest prefix that fits, or holds one row."""
    return f"""
WITH h AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
         right(repeat('0', {HASH_BITS}) || bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {HASH_BITS // 4}))::BIGINT), {HASH_BITS}) AS bits
  FROM documents),
p AS (SELECT doc_id, n_bytes, d, substr(bits, 1, d) AS shard FROM h, (SELECT unnest(range({HASH_BITS + 1})) AS d)),
s AS (SELECT d, shard, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM p GROUP BY d, shard),
f AS (SELECT d, shard, shard_bytes, shard_rows FROM s WHERE shard_bytes <= {limit} OR shard_rows = 1)
SELECT doc_id, n_bytes, arg_min(p.shard, p.d) AS shard, arg_min(shard_bytes, p.d) AS shard_bytes,
       arg_min(shard_rows, p.d) AS shard_rows
FROM p JOIN f ON p.d = f.d AND p.shard = f.shard
GROUP BY doc_id, n_bytes"""
