"""Hard negatives by coordinate pruning over length buckets (exact).

For every anchor: the rows of its label with the highest inner products are its positives, and for each
positive the highest scoring rows of other labels within a band below the positive's score are its
hard negatives.

Rows of one label are sorted by length and cut into buckets of bounded size.  A bucket holds its vectors
and, for each coordinate, a list of its vectors' directions sorted by it.  A score of at least t
asks of a row in a bucket of longest length l a cosine of at least c = t / (|anchor| l).  Above 1 the bucket
is passed over.  Else the row is within an angle of acos c of the anchor, so its angle to the f-th axis is the
anchor's give or take that much, which bounds its f-th coordinate from both sides.  For the anchor's largest
coordinates, the focus, that range is a slice of the sorted list; the slices are intersected, and what is
left is verified with whole numbers.  t rises as better rows are found.

Anchors go to all tasks in blocks of bounded size, one block after another; a task takes its buckets
in turn and returns for each anchor the few best rows of all of them, which are ranked once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.llm.common import bound_batches, give_back, save

POSITIVES = 5
NEGATIVES = 5
#: A negative's score is at least so many hundredths of the positive's, and at most all of it.
BAND = 80
#: Whole numbers for one unit of a component.
SCALE = 256
#: Rows of a bucket.
BUCKET = 4096
#: Bytes of vectors in a block of anchors, the bound of what is sent to every task.
ANCHOR_BYTES = 8 << 20
#: Coordinates whose lists are intersected.
FOCUS = 4
_EXACT = float(1 << 53)
_SLACK = 1e-5  # directions and their lists are single precision


# ---------------------------------------------------------------- buckets

def _whole(scale: int):
    """Rows that take part, with components as whole numbers (doubles) and their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, vecs, norms, dims = [], [], [], []
            for i, vec in enumerate(batch.column("vec")):
                if not vec.is_valid or vec.values.null_count or not len(vec.values):
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(scale * vec.values.to_numpy(zero_copy_only=False).astype(np.float64)) + 0.0
                    if not np.isfinite(x).all():
                        continue
                    norms.append(float(np.sqrt(x @ x)))
                keep.append(i)
                vecs.append(x.astype("<f8").tobytes())
                dims.append(len(x))
            part = batch.select(["key", "id", "label", "anchor"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(dims, pa.int32()), pa.array(norms, pa.float64()), pa.array(vecs, pa.binary())],
                names=[*part.schema.names, "dim", "norm", "vec"])

    return run


def _bucket(rows: pa.Table) -> pa.RecordBatch:
    """One bucket: rows by id (nulls last), their directions' sorted lists coordinate by coordinate."""
    rows = rows.sort_by([("id", "ascending"), ("key", "ascending")]).combine_chunks()
    dim = rows.column("dim")[0].as_py()
    x = np.frombuffer(b"".join(rows.column("vec").to_pylist()), "<f8").reshape(-1, dim)
    norm = rows.column("norm").to_numpy()
    with np.errstate(invalid="ignore", over="ignore"):
        along = np.where((norm > 0) & np.isfinite(norm), x.T / np.where(norm > 0, norm, 1), 0).astype("<f4")
    order = np.argsort(along, axis=1, kind="stable")
    lists = np.take_along_axis(along, order, axis=1)

    def one(column: str):
        return rows.column(column).combine_chunks().slice(0, 1)

    def many(values: pa.Array):
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.RecordBatch.from_arrays(
        [one("label"), one("dim"), pa.array([float(norm.max())]),
         many(rows.column("id").combine_chunks()), many(rows.column("key").combine_chunks()),
         pa.array([x.tobytes()], pa.binary()), pa.array([lists.tobytes()], pa.binary()),
         pa.array([order.astype("<u2").tobytes()], pa.binary())],
        names=["label", "dim", "norm", "ids", "keys", "vecs", "lists", "order"])


def _cut(size: int):
    """Rows sorted by label, dim and length, as buckets of at most ``size`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = list(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist()))
            start = 0
            for i in range(len(names) + 1):
                end = i == len(names)
                if end or names[i] != group or n + i - start == size:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                        n += i - start
                        start = i
                    if not end:
                        if held:
                            yield _bucket(pa.Table.from_batches(held))
                        held, n, group = [], 0, names[i]
        if held:
            yield _bucket(pa.Table.from_batches(held))

    return run


def _buckets(rows: DataFrame, size: int) -> DataFrame:
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}
    # Range partitions on the row's own key too, so that a hot label goes to many tasks.
    ordered = (rows.drop("anchor").repartitionByRange("label", "dim", F.desc("norm"), "key")
               .sortWithinPartitions("label", "dim", F.desc("norm"), "key"))
    return save(ordered.mapInArrow(
        _cut(min(size, 1 << 16)),
        f"label {kinds['label']}, dim int, norm double, ids array<{kinds['id']}>, keys array<long>, vecs binary, "
        f"lists binary, order binary"))


class _Bucket:
    """A bucket as a task reads it."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        self.label, self.dim, self.norm = (batch.column(c)[i].as_py() for c in ("label", "dim", "norm"))
        self.ids, self.keys = (batch.column(c)[i].values.to_pylist() for c in ("ids", "keys"))
        n = len(self.ids)
        self.x = np.frombuffer(batch.column("vecs")[i].as_buffer(), "<f8").reshape(n, self.dim)
        self.lists = np.frombuffer(batch.column("lists")[i].as_buffer(), "<f4").reshape(self.dim, n)
        self.order = np.frombuffer(batch.column("order")[i].as_buffer(), "<u2").reshape(self.dim, n)

    def candidates(self, anchor: _Anchor, least: float) -> np.ndarray | None:
        """Rows that may score ``least``, in order, by the sorted lists; None for all of them."""
        if least <= 0:
            return None
        reach = anchor.norm * self.norm
        if reach < least:
            return np.empty(0, np.int64)
        if not np.isfinite(reach):
            return None
        apart = np.arccos(least / reach)
        least_along = np.cos(np.minimum(np.pi, anchor.angle + apart)) - _SLACK
        most_along = np.cos(np.maximum(0, anchor.angle - apart)) + _SLACK
        slices = []
        for f, a, b in zip(anchor.focus, least_along, most_along):
            row = self.lists[f]
            low, high = np.searchsorted(row, np.float32(a), "left"), np.searchsorted(row, np.float32(b), "right")
            slices.append((high - low, f, low, high))
        slices.sort()
        if slices[0][0] * 2 > len(self.ids):
            return None  # the ranges exclude too little to pay for intersecting them
        _, f, low, high = slices[0]
        found = np.sort(self.order[f, low:high]).astype(np.int64)
        for _, f, low, high in slices[1:]:
            if (high - low) * 2 > len(self.ids):
                break
            found = np.intersect1d(found, self.order[f, low:high].astype(np.int64), assume_unique=True)
        return found

    def scores(self, anchor: _Anchor, rows: np.ndarray | None) -> list | np.ndarray:
        """Exact inner products: doubles where no partial sum can reach 2**53, else Python's whole numbers."""
        x = self.x if rows is None else self.x[rows]
        if anchor.norm * self.norm < _EXACT:
            return x @ anchor.x
        exact = [int(v) for v in anchor.x]
        return np.array([sum(a * int(b) for a, b in zip(exact, row)) for row in x], dtype=object)


class _Anchor:
    """An anchor as a task reads it, and the best rows found for each of its positives (or for itself)."""

    def __init__(self, row: dict):
        self.key, self.label, self.dim, self.norm = row["key"], row["label"], row["dim"], row["norm"]
        self.x = np.frombuffer(row["vec"], "<f8")
        with np.errstate(invalid="ignore", over="ignore"):
            along = self.x / self.norm if 0 < self.norm < np.inf else np.zeros(self.dim)
        self.focus = np.argsort(-np.abs(along), kind="stable")[:FOCUS]
        self.angle = np.arccos(np.clip(along[self.focus], -1, 1))


class _Best:
    """The first ``most`` of (score, id, key): high scores first, then small ids, nulls last."""

    def __init__(self, most: int):
        self.most, self.held = most, []

    def least(self) -> float | int:
        """The score that a row must reach to be taken."""
        return self.held[-1][0][0] * -1 if len(self.held) == self.most else -np.inf

    def add(self, scores, rows, bucket: _Bucket) -> None:
        if len(scores) > self.most:
            # Rows stand by id, so a stable sort keeps the order of ties.
            at = np.argsort(-scores, kind="stable")[:self.most]
            scores, rows = scores[at], rows[at]
        for s, i in zip(scores, rows):
            who = bucket.ids[i]
            self.held.append(((-int(s), who is None, 0 if who is None else who, bucket.keys[i]), who))
        self.held.sort(key=lambda h: h[0])
        del self.held[self.most:]

    def rows(self) -> list[tuple]:
        return [(order[3], who, -order[0]) for order, who in self.held]


def _find_positives(anchors, most: int):
    """For each anchor of a block: the best rows of its label among a task's buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict = {}
        for row in anchors.value.to_pylist():
            by.setdefault((row["label"], row["dim"]), []).append((_Anchor(row), _Best(most)))
        for batch in batches:
            for i in range(batch.num_rows):
                bucket = _Bucket(batch, i)
                for anchor, best in by.get((bucket.label, bucket.dim), ()):
                    rows = bucket.candidates(anchor, best.least())
                    scores = bucket.scores(anchor, rows)
                    rows = np.arange(len(bucket.ids)) if rows is None else rows
                    good = (scores >= best.least()) & (np.array(bucket.keys)[rows] != anchor.key)
                    best.add(scores[good], rows[good], bucket)
        found = [(a.key, *r) for group in by.values() for a, best in group for r in best.rows()]
        give_back()
        yield _found(found, ["key", "positive_key", "positive_id", "positive_score"], anchors.value.schema.field("id").type)

    return run


def _find_negatives(anchors, most: int, band: int):
    """For each anchor and positive of a block: the best rows of other labels in the positive's band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict = {}
        for row in anchors.value.to_pylist():
            # Equal scores of positives have equal negatives.
            tops = {p["positive_score"]: _Best(most) for p in row["positives"] if p["positive_score"] >= 0}
            by.setdefault(row["dim"], []).append((_Anchor(row), tops))
        for batch in batches:
            for i in range(batch.num_rows):
                bucket = _Bucket(batch, i)
                for anchor, tops in by.get(bucket.dim, ()):
                    if anchor.label == bucket.label or not tops:
                        continue
                    least = {s: max(-(-band * s // 100), best.least()) for s, best in tops.items()}
                    rows = bucket.candidates(anchor, min(least.values()))
                    scores = bucket.scores(anchor, rows)
                    rows = np.arange(len(bucket.ids)) if rows is None else rows
                    some = scores >= min(least.values())
                    scores, rows = scores[some], rows[some]
                    for s, best in tops.items():
                        good = (scores >= least[s]) & (scores <= s)
                        best.add(scores[good], rows[good], bucket)
        found = [(a.key, s, *r) for group in by.values() for a, tops in group
                 for s, best in tops.items() for r in best.rows()]
        give_back()
        yield _found(found, ["key", "positive_score", "negative_key", "negative_id", "negative_score"],
                     anchors.value.schema.field("id").type)

    return run


def _found(rows: list[tuple], names: list[str], id_kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, id_kind if name.endswith("_id") else pa.int64()) for c, name in zip(columns, names)], names=names)


def _in_blocks(anchors: DataFrame, buckets: DataFrame, run, schema: str, block_bytes: int) -> DataFrame | None:
    """``run`` over all buckets for each block of anchors; a block is what ``block_bytes`` holds."""
    sizes = anchors.agg(F.count(F.lit(1)), F.max("dim")).first()
    if not sizes[0]:
        return None
    n = -(-sizes[0] * (8 * sizes[1] + 256) // block_bytes)
    dealt = anchors if n == 1 else save(
        anchors.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n))), partition_by="block")
    out = None
    for k in range(n):
        block = dealt if n == 1 else dealt.where(F.col("block") == k).drop("block")
        sent = anchors.sparkSession.sparkContext.broadcast(block.toArrow())
        found = save(buckets.mapInArrow(run(sent), schema))
        sent.unpersist()
        out = found if out is None else out.unionByName(found)
    return out


def mine(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, band: int = BAND,
         scale: int = SCALE, bucket: int = BUCKET, block_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components are taken as floor(scale * x); a score is the exact inner product with the anchor.  ``anchors`` is a
    condition on rows.  An anchor's positives are its first ``positives`` other rows of the same label, by
    score, then smaller id; its negatives for each are the first ``negatives`` rows of other labels whose score
    is from ``band`` hundredths to all of the positive's (none if that is negative).

    No part is taken by rows with a null label, a vector that is null, empty or holds a null or non-finite
    component (also once scaled), and vectors meet only vectors of their own dimension.  A row is itself
    whatever its id: rows with equal ids are rows of their own, also of each other's positives; null ids
    come last among ties, and are anchors only if the condition says so.  Zero vectors score 0.  Scores beyond a
    long fail.  Other columns are not read; an empty table gives an empty result."""
    spark = vectors.sparkSession
    bound_batches(spark)
    source = vectors.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").alias("vec"),
        F.coalesce(anchors, F.lit(False)).alias("anchor")).where("label is not null")
    kinds = {c: source.schema[c].dataType.simpleString() for c in ("id", "label")}
    rows = save(source.withColumn("key", F.monotonically_increasing_id()).mapInArrow(
        _whole(scale), f"key long, id {kinds['id']}, label {kinds['label']}, anchor boolean, dim int, norm double, vec binary"))
    asked = save(rows.where("anchor").select("key", "id", "label", "dim", "norm", "vec"))
    empty = spark.createDataFrame([], T.StructType([
        T.StructField("anchor_id", source.schema["id"].dataType), T.StructField("positive_id", source.schema["id"].dataType),
        T.StructField("rank", T.IntegerType()), T.StructField("negative_id", source.schema["id"].dataType),
        T.StructField("positive_score", T.LongType()), T.StructField("negative_score", T.LongType())]))
    buckets = _buckets(rows, bucket)

    near = _in_blocks(asked, buckets, lambda b: _find_positives(b, positives),
                      f"key long, positive_key long, positive_id {kinds['id']}, positive_score long", block_bytes)
    if near is None:
        return empty
    first = Window.partitionBy("key").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), "positive_key")
    chosen = save(near.withColumn("r", F.row_number().over(first)).where(F.col("r") <= positives))
    listed = chosen.groupBy("key").agg(F.collect_list(F.struct("positive_score")).alias("positives"))
    far = _in_blocks(save(asked.join(listed, "key")), buckets, lambda b: _find_negatives(b, negatives, band),
                     f"key long, positive_score long, negative_key long, negative_id {kinds['id']}, negative_score long",
                     block_bytes)
    if far is None:
        return empty
    best = Window.partitionBy("key", "positive_score").orderBy(
        F.desc("negative_score"), F.asc_nulls_last("negative_id"), "negative_key")
    ranked = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return (chosen.join(ranked, ["key", "positive_score"])
            .join(asked.select("key", F.col("id").alias("anchor_id")), "key")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def relabelled(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label") -> DataFrame:
    """``vectors`` where rows whose id is divisible by 7 have the label after theirs, of ten."""
    label = F.col(f"`{label_col}`")
    return vectors.withColumn(label_col, F.when(F.col(f"`{id_col}`") % 7 == 0, (label + 1) % 10).otherwise(label))


def brute_force(rows: list[tuple], anchors: set, positives: int = POSITIVES, negatives: int = NEGATIVES,
                band: int = BAND, scale: int = SCALE) -> list[tuple]:
    """What ``mine`` returns for (id, label, vector) rows, by scoring all of them; ids in ``anchors`` ask."""
    held = []
    for i, label, vec in rows:
        if label is not None and vec is not None and len(vec) and None not in vec and np.isfinite(vec).all():
            held.append((i, label, [int(np.floor(scale * float(x))) for x in vec]))

    def order(r):
        return (-r[1], r[0][0] is None, 0 if r[0][0] is None else r[0][0])

    out = []
    for a in held:
        if a[0] not in anchors:
            continue
        scored = [(b, sum(x * y for x, y in zip(a[2], b[2]))) for b in held if b is not a and len(b[2]) == len(a[2])]
        for p, ps in sorted([r for r in scored if r[0][1] == a[1]], key=order)[:positives]:
            ns = [r for r in scored if r[0][1] != a[1] and band * ps <= 100 * r[1] <= 100 * ps]
            for k, (n, s) in enumerate(sorted(ns, key=order)[:negatives], 1):
                out.append((a[0], p[0], k, n[0], ps, s))
    return out


ORACLE = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
 AND {BAND} * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= {NEGATIVES}"""
