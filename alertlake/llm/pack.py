"""Best-fit packing of token sequences.

Every document becomes one piece, longer ones several.  Pieces are range-sorted by length over all
tasks, longest first, so each has a rank.  Equal lengths form a run of ranks, and sequences
with equal room form a run of sequences.  A round takes the next length: it sweeps the rooms, sorted
likewise, upward from the smallest that fits (the successor), gives each sequence there as many
pieces as fit, settles by rank which piece goes to which sequence, updates the rooms, and repeats until
no piece of that length is left; then sequences are opened.

That is best-fit decreasing exactly, with runs in place of single pieces.  There are at most
as many runs of pieces as there are lengths (2048), whatever the number of documents, so a round needs no
data but their counts; the pieces find their places in parallel, from their ranks alone.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlake.llm.bpe import BLOCK_BYTES, encoder
from alertlake.llm.common import bound_batches, save, slices

CAPACITY = 2048
#: The id after each document.
END_ID = 0
_LOCAL = (1 << 33) - 1  # monotonically_increasing_id(): the partition above these bits


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and ``END_ID``, cut at ``capacity``."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(tokenizer), np.array([END_ID], "<u4").tobytes()
        for part in slices(batches, "text", BLOCK_BYTES):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(own.text_ids(part.column(1))):
                coded = ids.tobytes() + end
                for k, a in enumerate(range(0, len(coded), 4 * capacity)):
                    cut = coded[a:a + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(a // 4)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Where the pieces go, from the number of pieces of each length.

    Rows (first rank, length, pieces a sequence, first sequence, offset), by rank.  From its first rank on, a
    row's pieces fill sequence after sequence, that many in each, from that offset."""
    rooms: list[int] = []  # sorted
    runs: dict[int, list[tuple[int, int]]] = {}  # by room: first sequence, number of sequences
    out, rank, opened = [], 0, 0

    def free(room: int, first: int, number: int) -> None:
        if room and number:
            if room not in runs:
                insort(rooms, room)
                runs[room] = []
            runs[room].append((first, number))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[at]
            else:
                room, first = capacity, opened
                number = -(-left // (capacity // length))
                opened += number
            each = min(room // length, left)
            full = min(number, left // each)
            out.append((rank, length, each, first, capacity - room))
            free(room, first + full, number - full)
            free(room - each * length, first, full)
            rank += full * each
            left -= full * each
    return np.array(out, np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``doc_id``, ``piece``, ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Sequences hold ``capacity`` tokens at most; each sequence's pieces fill it from 0 without gaps.  Pieces of
    one length are placed in the order of doc_id and piece; an empty table stays empty."""
    spark = pieces.sparkSession
    names = pieces.columns
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = save(pieces.repartitionByRange(parts, F.col("length").desc(), "doc_id", "piece")
                  .sortWithinPartitions(F.col("length").desc(), "doc_id", "piece")
                  .withColumn("place", F.monotonically_increasing_id()))
    # One number per task, and one per length.
    task = F.shiftright("place", 33).cast("long")
    held = {r.task: r.n for r in ranged.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before = np.zeros(1 + max(held, default=0), np.int64)
    for t, n in held.items():
        before[t] = n
    before = np.cumsum(before) - before
    lengths = {r.length: r.n for r in ranged.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if lengths and (min(lengths) < 1 or max(lengths) > capacity):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    plan = best_fit(lengths, capacity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column(batch.schema.get_field_index("place")).to_numpy()
            rank = before[place >> 33] + (place & _LOCAL)
            rows = plan[np.searchsorted(plan[:, 0], rank, side="right") - 1]
            nth = rank - rows[:, 0]
            sequence = rows[:, 3] + nth // rows[:, 2]
            offset = rows[:, 4] + nth % rows[:, 2] * rows[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in names], pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranged.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: the id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A null or empty text is the end id alone.  Repeated rows, also of a null id, are packed one by one.
    Other columns are not read; an empty table gives an empty result."""
    placed = pack(save(token_pieces(docs, tokenizer, id_col, text_col, capacity)), capacity)
    return placed.withColumnRenamed("doc_id", id_col)


def brute_force(lengths: list[int], capacity: int = CAPACITY) -> list[int]:
    """Best-fit decreasing piece by piece: the room left in each sequence."""
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(capacity - n)
    return sorted(rooms)
