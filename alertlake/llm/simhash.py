"""SimHash near-duplicates by covering locality-sensitive hashing.

Two fingerprints that differ in at most ``radius`` bits must be found, all of them.  Each of
the 64 bit places gets a non-zero vector of ``radius + 1`` bits.  For every non-zero vector v,
one table masks the places whose vector has an odd product with v.  The vectors of at most
``radius`` differing places span less than the whole space, so some v is orthogonal to all of
them: its table masks none of the differing places, and the pair collides there.

Fingerprints are compared once each, however many documents share one.  A bucket of a table
with more than ``BUCKET`` different fingerprints is split without loss: the places outside its
mask are cut into ``radius + 1`` blocks, and a pair agrees on one of these at least, so each
block's bits extend the bucket's key in turn.  With every split fewer places are free; a bucket
of f free places has at most 2**f fingerprints, so splitting ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlake.llm.common import bound_batches, save, slices
from alertlake.llm.components import Forest, components

SHINGLE = 3
RADIUS = 3
SEED = 42
#: The most fingerprints that are compared with each other in one bucket.
BUCKET = 1024
ALL = (1 << 64) - 1
#: Bytes of a text whose words are held together, and shingles whose votes are added up together.
RUN_BYTES = 1 << 18
VOTES = 1 << 15
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_masks(radius: int = RADIUS, places: int = 64) -> list[int]:
    """The 2**(radius+1) - 1 masks; the vectors are dealt to the places in turn."""
    vectors = range(1, 1 << (radius + 1))
    of_place = [1 + i % len(vectors) for i in range(places)]
    return [sum(1 << i for i, x in enumerate(of_place) if (x & v).bit_count() & 1) for v in vectors]


def _runs(raw: bytes) -> Iterator[list[bytes]]:
    """A text's words, in runs of about ``RUN_BYTES`` (one word at least)."""
    at = 0
    while at < len(raw):
        space = _SPACE.search(raw, at + RUN_BYTES)
        end = space.start() if space else len(raw)
        words = raw[at:end].split()
        if words:
            yield words
        at = end


def _shingle_hashes(text: str, size: int) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles, run by run; each run goes on with the last words of the one before."""
    raw = text.encode().lower()  # bytes: only A-Z and, in split(), ASCII white space
    digest, held, some = xxhash.xxh64_intdigest, [], False
    for words in _runs(raw):
        held += words
        if len(held) >= size:
            some = True
            yield np.array([digest(b" ".join(s), SEED) for s in zip(*(held[i:] for i in range(size)))], "<u8")
            held = held[len(held) - size + 1:]
    if held and not some:
        yield np.array([digest(b" ".join(held), SEED)], "<u8")


def _votes(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """How many of the hashes from each place on have each bit."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, begin, axis=0, dtype=np.int32)


def _fingerprints(texts: list[str | None], size: int) -> np.ndarray:
    """64 majority votes for each text; none without words.  The votes of a long text are added up run by run."""
    votes, counts = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held: list[tuple[int, np.ndarray]] = []
    waiting = 0

    def close() -> None:
        if held:
            size_of = np.array([len(h) for _, h in held])
            own = np.array([i for i, _ in held])
            np.add.at(votes, own, _votes(np.concatenate([h for _, h in held]), np.cumsum(size_of) - size_of))
            np.add.at(counts, own, size_of)
            held.clear()

    for i, text in enumerate(texts):
        for hashes in _shingle_hashes(text or "", size):
            held.append((i, hashes))
            waiting += len(hashes)
            if waiting >= VOTES:
                close()
                waiting = 0
    close()
    return np.packbits(votes * 2 > counts[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint as a signed long) of each row of ``docs``."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            prints = _fingerprints(part.column(1).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints.view(np.int64))],
                                             names=["doc_id", "print"])

    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, print long")


def _blocks(mask: int, parts: int) -> list[int]:
    """The places outside ``mask``, cut into ``parts`` blocks; each extends the mask."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << int(i) for i in block) for block in np.array_split(free, parts) if len(block)]


def _buckets(prints: DataFrame, masks: DataFrame) -> DataFrame:
    """(mask, key, print): every print under every mask given with it."""
    return masks.select("mask", F.col("mask").bitwiseAND(F.col("print")).alias("key"), "print")


def _link(radius: int):
    """Compare the prints of each (mask, key), which stand together, and keep a spanning forest."""

    def compare(prints: np.ndarray) -> np.ndarray:
        forest, found = Forest(len(prints)), []
        values = prints.view(np.uint64)
        for i in range(len(values) - 1):
            near = i + 1 + np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= radius)
            if len(near):
                new = forest.add(i, near)
                if len(new):
                    found.append(np.stack([np.full(len(new), prints[i]), prints[new]]))
        return np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((3, 0), np.int64)
        for batch in batches:
            now = np.stack([batch.column(i).to_numpy() for i in range(3)])
            held = np.concatenate([held, now], axis=1)
            if not held.shape[1]:
                continue
            cut = np.flatnonzero(np.any(held[:2, 1:] != held[:2, :-1], axis=0)) + 1
            if len(cut):  # the last bucket may go on in the next batch
                yield from emit(held[2, :cut[-1]], cut[:-1])
                held = held[:, cut[-1]:]
        if held.shape[1]:
            yield from emit(held[2], np.empty(0, int))

    def emit(prints: np.ndarray, cut: np.ndarray) -> Iterator[pa.RecordBatch]:
        links = [compare(p) for p in np.split(prints, cut)]
        found = np.concatenate(links, axis=1)
        if found.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

    return run


def print_links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between different fingerprints (column ``print``, each once).

    All of them differ in at most ``radius`` bits, and together they join whatever a chain of
    such pairs joins."""
    if bucket < 1 << (radius + 1):
        raise ValueError("a bucket must hold 2**(radius + 1) fingerprints, or it may not be split without loss")
    spark = prints.sparkSession
    parts = radius + 1
    masks = F.explode(F.array(*[F.lit(_signed(m)) for m in covering_masks(radius)]))
    open_rows = prints.select(masks.alias("mask"), "print")
    found = None
    while True:
        rows = _buckets(prints, open_rows)
        sizes = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        # A print alone in its bucket has no partner there; the join drops it before any comparison.
        rows = save(rows.join(sizes, ["mask", "key"]))
        small = rows.where(F.col("n") <= bucket).select("mask", "key", "print")
        near = save(small.repartition("mask", "key").sortWithinPartitions("mask", "key")
                    .mapInArrow(_link(radius), "a long, b long"))
        found = near if found is None else found.unionByName(near)
        large = rows.where(F.col("n") > bucket)
        wide = [r.mask for r in large.select("mask").distinct().collect()]  # a subset of the masks in use
        if not wide:
            return found
        finer = spark.createDataFrame([(m, _signed(x)) for m in wide for x in _blocks(m & ALL, parts)],
                                      "mask long, finer long")
        open_rows = large.join(F.broadcast(finer), "mask").select(F.col("finer").alias("mask"), "print").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hex digits), ``component_id``.

    The component's id is the smallest id reachable over fingerprints that differ in at most
    ``radius`` bits.  A text without words, a null one too, has fingerprint zero and is linked
    like any other; fewer words than ``shingle`` form one shingle.  Equal texts, repeated rows
    and repeated ids share a fingerprint and so a component; a null id is never the smallest
    unless all are null.  Other columns are not read; an empty table gives an empty result."""
    rows = save(fingerprints(docs, id_col, text_col, shingle))
    least = rows.groupBy("print").agg(F.min("doc_id").alias("least"))
    links = print_links(least.select("print"), radius)
    joined = components(links)
    # One row per linked fingerprint; unlinked ones are components of their own.
    named = least.join(joined.withColumnRenamed("node", "print"), "print", "left")
    named = named.withColumn("component", F.coalesce("component", "print"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    # A table of its own: AQE may then split the partition of a fingerprint that many documents share.
    named = save(named.join(smallest, "component").select("print", "component_id"))
    return rows.join(named, "print").select(
        F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with exactly one row of each component, the one with the smallest id.

    Null ids come last.  Of several rows with that id, equal or not, one stays.  The rows are written down
    with a key of their own, so repeated ids take no other row with them."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    i, text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    keyed = save(docs.toDF(*names).withColumn("key", F.monotonically_increasing_id()))
    rows = keyed.select(F.struct(F.col(i).isNull().alias("none"), F.col(i).alias("id"), "key").alias("row"), text)
    groups = near_duplicates(rows, "row", text, **how)
    drop = groups.where(F.col("row.key") != F.col("component_id.key")).select("row.key")
    return keyed.join(drop, "key", "left_anti").select(*names).toDF(*docs.columns)


def brute_force(rows: list[tuple], shingle: int = SHINGLE, radius: int = RADIUS) -> list[tuple]:
    """What ``near_duplicates`` returns for (id, text) rows, by comparing all pairs."""
    prints = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        shingles = [words[i:i + shingle] for i in range(max(1, len(words) - shingle + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(b" ".join(x), SEED) for x in shingles]
        ones = [2 * sum(h >> i & 1 for h in hashes) > len(hashes) for i in range(64)]
        prints.append(sum(1 << i for i, one in enumerate(ones) if one))
    label = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for i, p in enumerate(prints):
            for j, q in enumerate(prints):
                if (p ^ q).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return [(i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, label)]
