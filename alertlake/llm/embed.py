"""Near-duplicate embeddings by an exact metric range join.

Vectors of one label are compared by cosine.  On the unit sphere, cosine >= t means a distance
of at most r = sqrt(2 - 2t), so this is a range join in a metric space.  Pivots, a bounded sample
of the vectors, partition a large label into cells (each vector's nearest pivot).  A vector
is copied to another pivot's cell unless the triangle inequality, in the sharper form it has in
Euclidean space, keeps every vector of that cell farther than r away: it does so where the vector
is more than r from the plane half-way between the two pivots.  So each vector finds all its
partners in its home cell, and the cells join independently.

A cell with more than ``BLOCK`` vectors is joined in tiles of bounded size, so no task
holds a whole cell.  Identical vectors are one class with a count, and a tile returns counts and
a spanning forest of its links instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.llm.common import bound_batches, save
from alertlake.llm.components import Forest, components

THRESHOLD = 0.93
#: Vectors a side of a tile; also the cell size that the number of pivots aims at.
BLOCK = 2048
#: Pivots over all labels, the bound of what is sent to every task; the largest labels come first.
MAX_PIVOTS = 4096
_CHUNK = 256  # rows of a tile that are multiplied together
#: Products of vectors and pivots that a task holds at once.
PRODUCTS = 1 << 21


def _matrix(raw: pa.Array, kind: str) -> np.ndarray:
    """Vectors as rows of doubles, each scaled by a power of two (exactly) to a largest part near 1."""
    flat = np.frombuffer(b"".join(raw.to_pylist()), kind).astype(np.float64).reshape(len(raw), -1)
    _, power = np.frexp(np.abs(flat).max(axis=1))
    return np.ldexp(flat, -power[:, None])


def _checked(kind: str):
    """(id, label, dim, vec): a vector's bytes, null where it can link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs, dims = [], []
            for label, vec in zip(batch.column(1).to_pylist(), batch.column(2)):
                values = None if label is None or not vec.is_valid or vec.values.null_count else \
                    vec.values.to_numpy(zero_copy_only=False).astype(kind) + 0.0  # -0.0 is 0.0
                good = values is not None and len(values) and np.isfinite(values).all() and values.any()
                vecs.append(values.astype(kind).tobytes() if good else None)
                dims.append(len(values) if good else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())],
                names=["id", "label", "dim", "vec"])

    return run


def _pivots(classes: DataFrame, kind: str, block: int) -> dict:
    """Unit pivots by (label, dim), for labels of more than ``block`` different vectors."""
    sizes = (classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
             .orderBy(F.col("n").desc()).limit(MAX_PIVOTS // 2))
    left, share = MAX_PIVOTS, []
    for r in sizes.collect():
        take = min(-(-r.n // block), left)
        left -= take
        if take > 1:
            share.append((r.label, r.dim, r.n, take))
    if not share:
        return {}
    wanted = classes.sparkSession.createDataFrame(
        share, T.StructType([classes.schema["label"], T.StructField("dim", T.IntegerType()),
                             T.StructField("total", T.LongType()), T.StructField("take", T.LongType())]))
    # About four times as many candidates as pivots, by hash; the first few of each label are used.
    mark = F.pmod(F.xxhash64("vec"), F.col("total"))
    sample = (classes.join(F.broadcast(wanted), ["label", "dim"]).where(mark < 4 * F.col("take"))
              .select("label", "dim", "take", "vec", mark.alias("mark")).collect())
    found: dict = {}
    for r in sorted(sample, key=lambda r: (r.mark, bytes(r.vec))):
        own = found.setdefault((r.label, r.dim), [])
        if len(own) < r.take:
            own.append(bytes(r.vec))
    out = {}
    for key, raw in found.items():
        m = _matrix(pa.array(raw, pa.binary()), kind)
        out[key] = np.unique(m / np.linalg.norm(m, axis=1, keepdims=True), axis=0)
    return out


def _apart(centres: np.ndarray) -> np.ndarray:
    """The distances of all pivots of a label, rounded up; a pivot is 1 from itself.

    Made row by row from differences, as products would not tell close pivots apart.  A distance that is a little
    too large copies a vector to a cell more, never less."""
    out = np.empty((len(centres), len(centres)), np.float32)
    for i, c in enumerate(centres):
        out[i] = np.nextafter(np.linalg.norm(centres - c, axis=1).astype(np.float32), np.float32(np.inf))
    np.fill_diagonal(out, 1)
    return out


def _cells(pivots, kind: str, radius: float):
    """Rows of a class table with ``cell`` and ``home``: the home cell, and those it is copied to.

    A task measures the pivots of a label once; at most MAX_PIVOTS altogether, 64 MB."""
    known: dict = {}

    def nearest(x: np.ndarray, centres: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        dots = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ centres.T
        own = dots.argmax(axis=1)
        beyond = (dots[np.arange(len(x)), own][:, None] - dots) / apart[own]
        at, cell = np.nonzero(beyond <= radius + 1e-9)
        return at, cell, cell == own[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, dims = batch.column("label").to_pylist(), batch.column("dim").to_pylist()
            groups: dict = {}
            for i, key in enumerate(zip(labels, dims)):
                groups.setdefault(key, []).append(i)
            for key, members in groups.items():
                rows = pa.array(members)
                part = batch.take(rows)
                centres = pivots.value.get(key)
                if centres is None:
                    at, cell, home = np.arange(len(members)), np.zeros(len(members), int), np.ones(len(members), bool)
                else:
                    if key not in known:
                        known[key] = _apart(centres)
                    x = _matrix(part.column("vec"), kind)
                    step = max(1, PRODUCTS // len(centres))
                    found = [(at + k, *rest) for k in range(0, len(x), step)
                             for at, *rest in [nearest(x[k:k + step], centres, known[key])]]
                    at, cell, home = map(np.concatenate, zip(*found))
                copies = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*copies.columns, pa.array(cell, pa.int32()), pa.array(home)],
                    names=[*copies.schema.names, "cell", "home"])

    return run


def _join_tile(kind: str, threshold: float):
    """All links between a tile's home vectors and its members: counts, and a spanning forest."""

    def run(tile: pa.Table) -> pa.Table:
        tile = tile.combine_chunks()
        ids, n = tile.column("class").to_numpy(), tile.column("n").to_numpy()
        x = _matrix(tile.column("vec").combine_chunks(), kind)
        norm = np.sqrt((x * x).sum(axis=1))
        homes = np.flatnonzero(tile.column("as_home").to_numpy(zero_copy_only=False))
        members = np.flatnonzero(tile.column("as_member").to_numpy(zero_copy_only=False))
        other, other_norm = x[members].T.copy(), norm[members]
        forest, who, links, a, b = Forest(len(x)), [], [], [], []
        for at in range(0, len(homes), _CHUNK):
            h = homes[at:at + _CHUNK]
            near = (x[h] @ other) / (norm[h][:, None] * other_norm) >= threshold
            near &= h[:, None] != members
            for i in np.flatnonzero(near.any(axis=1)):
                partners = members[near[i]]
                who.append(ids[h[i]])
                links.append(int(n[partners].sum()))
                new = forest.add(h[i], partners)
                a.extend([ids[h[i]]] * len(new))
                b.extend(ids[new].tolist())
        return pa.table({
            "a": pa.array([*who, *a], pa.int64()), "b": pa.array([None] * len(who) + b, pa.int64()),
            "links": pa.array([*links, *[0] * len(a)], pa.int64())})

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: its id, ``n_links``, ``component_id``, ``kept``.

    Two rows are linked when their labels are equal, their vectors equally long, and the
    cosine, in double precision, at least ``threshold``.  A null label and a vector that is null, empty,
    zero, or holds a null or non-finite part link with nothing: such a row is a component of its
    own.  Rows with equal vectors, also repeated rows, are linked and counted one by one.
    ``component_id`` is the smallest id reachable (nulls aside), ``kept`` whether it is the row's own.
    Other columns are not read; an empty table gives an empty result."""
    spark = vectors.sparkSession
    bound_batches(spark)
    source = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
                            F.col(f"`{vector_col}`").alias("vec"))
    kind = "<f4" if isinstance(source.schema["vec"].dataType.elementType, T.FloatType) else "<f8"
    id_kind, label_kind = (source.schema[c].dataType.simpleString() for c in ("id", "label"))
    rows = save(source.mapInArrow(_checked(kind), f"id {id_kind}, label {label_kind}, dim int, vec binary"))

    grouped = rows.where("vec is not null").groupBy("label", "dim", "vec").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = save(grouped.withColumn("class", F.monotonically_increasing_id()))

    pivots = spark.sparkContext.broadcast(_pivots(classes, kind, block))
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    in_cells = classes.select("class", "n", "label", "dim", "vec").mapInArrow(
        _cells(pivots, kind, radius),
        f"class long, n long, label {label_kind}, dim int, vec binary, cell int, home boolean")
    tiles = _tiles(save(in_cells), block)
    found = save(tiles.groupBy("label", "dim", "cell", "across", "down").applyInArrow(
        _join_tile(kind, threshold), "a long, b long, links long"))

    counts = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    joined = components(found.where("b is not null").select("a", "b"))
    named = (classes.join(joined.withColumnRenamed("node", "class"), "class", "left").join(counts, "class", "left")
             .withColumn("component", F.coalesce("component", "class")))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    # A table of its own: AQE may then split the partition of a vector that many rows share.
    named = save(named.join(smallest, "component").select(
        "label", "dim", "vec", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))

    linked = rows.where("vec is not null").join(named, ["label", "dim", "vec"]).select("id", "n_links", "component_id")
    alone = rows.where("vec is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _tiles(cells: DataFrame, block: int) -> DataFrame:
    """Rows dealt to the tiles of their cell: as one of the compared (``as_home``), as a member, or both."""
    sizes = cells.groupBy("label", "dim", "cell").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / block).cast("int").alias("rows"),
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("columns")).where("columns > 1")
    one = F.lit(1)
    placed = (cells.join(sizes, ["label", "dim", "cell"], "left")
              .withColumn("rows", F.greatest(F.coalesce("rows", one), one)).withColumn("columns", F.coalesce("columns", one))
              .withColumn("row", F.pmod(F.xxhash64("class"), F.col("rows")).cast("int"))
              .withColumn("column", F.pmod(F.xxhash64("class"), F.col("columns")).cast("int")))
    along = F.transform(F.sequence(F.lit(0), F.col("columns") - 1),
                        lambda c: F.struct(F.col("row").alias("down"), c.alias("across")))
    upright = F.transform(F.sequence(F.lit(0), F.col("rows") - 1),
                          lambda r: F.struct(r.alias("down"), F.col("column").alias("across")))
    here = F.when(F.col("home"), F.array_union(along, upright)).otherwise(upright)
    return (placed.withColumn("tile", F.explode(here))
            .select("class", "n", "label", "dim", "vec", "cell", F.col("tile.down").alias("down"),
                    F.col("tile.across").alias("across"),
                    (F.col("home") & (F.col("tile.down") == F.col("row"))).alias("as_home"),
                    (F.col("tile.across") == F.col("column")).alias("as_member")))


def brute_force(rows: list[tuple], threshold: float = THRESHOLD) -> list[tuple]:
    """What ``near_duplicates`` returns for (id, label, vector) rows, by comparing all pairs."""
    def good(label, vec):
        return (label is not None and vec is not None and len(vec) and None not in vec
                and np.isfinite(vec).all() and any(vec))

    near: list[list[int]] = [[] for _ in rows]
    for i, (_, la, va) in enumerate(rows):
        for j, (_, lb, vb) in enumerate(rows):
            if i != j and la == lb and good(la, va) and good(lb, vb) and len(va) == len(vb):
                x, y = np.array(va, float), np.array(vb, float)
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                    near[i].append(j)
    label = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for i, partners in enumerate(near):
            low = min([label[i], *(label[j] for j in partners)])
            if low < label[i]:
                label[i], changed = low, True
    return [(r[0], len(near[i]), label[i], r[0] == label[i]) for i, r in enumerate(rows)]


ORACLE = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
   AND list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach(node, other) AS (
  SELECT a, b FROM p
  UNION SELECT reach.node, p.b FROM reach JOIN p ON reach.other = p.a),
low AS (SELECT node, min(other) AS other FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(low.other, vec_id)) AS component_id,
       vec_id <= coalesce(low.other, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN low ON low.node = vec_id"""
