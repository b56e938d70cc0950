"""Line de-duplication by an exact set-similarity join.

The tokens of a line are its different five-word shingles (all its words, if it has fewer).  Two lines
match if the Jaccard similarity of their tokens is at least 0.8; a line that matches an earlier one,
by document id and place, is removed.

1. Every line gets a key (a hash of its words) and tokens are counted over all lines, in a sketch of fixed size.
2. A line's tokens are ordered by that rarity.  Two lines that match share one of their first
   n - ceil(0.8 n) + 1 tokens (prefix filter), so only these are shuffled.  Lines of equal words have equal keys
   and count once.
3. Lines that share such a token form a group; groups of the same lines are one.  A pair is
   ruled out by its sizes (length filter) or by where the shared token stands (positional filter).
4. The tokens of lines in groups are compared.  A large group is cut into blocks of bounded size, and each
   pair of blocks is a task of its own; it returns the lines that have an earlier match, not pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlake.llm.common import bound_batches, save, slices

SHINGLE = 5
#: The similarity as a fraction, so that limits are exact.
NUMERATOR, DENOMINATOR = 4, 5
#: Cells of the rarity sketch (a power of two).  Any order gives the same result; rarity makes groups small.
CELL_BITS = 18
CELLS = 1 << CELL_BITS
#: Bits of the filter that tells which lines' tokens are needed (a power of two).  Where it gets full, more
#: tokens than needed are shuffled.
FILTER_BITS = 1 << 27
#: Lines and tokens of a block; two blocks are compared in one task.
BLOCK, BLOCK_TOKENS = 1024, 500_000
#: Rows of one token that are held to recognise groups of the same lines.
HELD = 1 << 20
#: Tiles of at most so many lines are compared together, about so many tokens at once.
FEW, FEW_TOKENS = 32, 1 << 18
#: Words of at most so many bytes are hashed eight bytes at a time.
WORD_BYTES = 64
_FILTER_BLOCK = 17
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_WEIGHTS = _mix(np.arange(1, 4097, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)


def _weights(at: np.ndarray) -> np.ndarray:
    """An odd random factor for each position."""
    if not len(at) or at.max() < len(_WEIGHTS):
        return _WEIGHTS[at]
    return _mix((at.astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15)) | _U(1)


def _hash_runs(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One hash for each run of values, by their order (a sum of weighted values)."""
    at = np.arange(len(values)) - np.repeat(begin, size)
    return _mix(np.add.reduceat(values * _weights(at), begin) + size.astype(np.uint64))


#: By their number, from 0 to 8: the first bytes of eight.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _hash_words(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One hash for each word of ``data``, whose length is a multiple of 8 and which ends with 8 bytes or more of no word."""
    out = _WEIGHTS[np.minimum(size, WORD_BYTES)]
    eight = data.view("<u8")
    live = np.flatnonzero(size <= WORD_BYTES)
    for start in range(0, WORD_BYTES, 8):
        if start:
            live = live[size[live] > start]
        if not len(live):
            break
        at = begin[live] + start
        near, bits = at >> 3, ((at & 7) << 3).astype(np.uint64)
        piece = (eight[near] >> bits) | (eight[near + 1] << _U(1) << (_U(63) - bits))
        piece &= _FIRST_BYTES[np.minimum(size[live] - start, 8)]
        out[live] = _mix(out[live] + piece)
    long = np.flatnonzero(size > WORD_BYTES)
    if len(long):
        held = size[long]
        first = np.cumsum(held) - held
        at = np.repeat(begin[long] - first, held) + np.arange(held.sum())
        out[long] = _hash_runs(data[at].astype(np.uint64) + _U(1), first, held)
    return out


class Lines:
    """The lines of a slice of texts: for each line its text's number, place, and key (0 without words)."""

    def __init__(self, texts: pa.Array):
        raw = [(t or "").encode() for t in texts.to_pylist()]
        joined = b"\n".join(raw) + b"\n"
        padded = np.frombuffer(joined + bytes(16 - len(joined) % 8), np.uint8)
        data = padded[:len(joined)]
        breaks = np.flatnonzero(data == 10)
        ends = np.cumsum([len(r) + 1 for r in raw]) - 1  # each text's last line break
        self.text = np.searchsorted(ends, breaks)
        before = np.searchsorted(breaks, np.append(0, ends[:-1] + 1))
        self.place = np.arange(len(breaks)) - before[self.text]

        space = (data == 32) | (data - np.uint8(9) < 5)  # 9 to 13
        turns = np.flatnonzero(np.append(~space[:1], space[1:] != space[:-1]))
        begin, end = turns[::2], turns[1::2]
        self.words = np.diff(np.searchsorted(begin, breaks), prepend=0)
        self.of = np.repeat(np.arange(len(breaks)), self.words)
        self.word = _hash_words(padded, begin, end - begin)
        self.key = np.zeros(len(breaks), np.uint64)
        full = np.flatnonzero(self.words)
        if len(full):
            held = self.words[full]
            self.key[full] = _hash_runs(self.word, np.cumsum(held) - held, held)

    def first(self) -> np.ndarray:
        """Which lines with words are the first of their key."""
        _, at = np.unique(self.key, return_index=True)
        out = np.zeros(len(self.key), bool)
        out[at] = True
        return out & (self.words > 0)

    def tokens(self, use: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of the chosen lines, each as often as it occurs, and their lines, in order."""
        some = use[self.of]
        word, of = self.word[some], self.of[some]
        many = max(0, len(word) - shingle + 1)
        token = np.zeros(many, np.uint64)
        for k in range(shingle):
            token += word[k:k + many] * _WEIGHTS[100 + k]
        inside = of[:many] == of[shingle - 1:shingle - 1 + many]
        short = np.flatnonzero(use & (self.words > 0) & (self.words < shingle))
        return np.concatenate([_mix(token[inside]), self.key[short]]), np.concatenate([of[:many][inside], short])

    def sets(self, use: np.ndarray, rank: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The different tokens of the chosen lines and their lines, by line and token.

        With a rank for each cell of the sketch, a line's tokens are in the order of rank and token."""
        token, line = self.tokens(use)
        # One sort by line and a token's high bits; where these agree for different tokens, one by all.
        rough = line.astype(np.uint64) << _U(40)
        if rank is None:
            rough |= token >> _U(24)
        else:
            rough |= (rank[_cells(token)] << _U(40 - CELL_BITS)) | (token >> _U(24 + CELL_BITS))
        order = np.argsort(rough)
        token, line, rough = token[order], line[order], rough[order]
        if len(self.key) > 1 << 24 or np.any((rough[1:] == rough[:-1]) & (token[1:] != token[:-1])):
            order = np.lexsort((token, line) if rank is None else (token, rank[_cells(token)], line))
            token, line = token[order], line[order]
        new = np.ones(len(token), bool)
        new[1:] = (line[1:] != line[:-1]) | (token[1:] != token[:-1])
        return token[new], line[new]


def _cells(token: np.ndarray) -> np.ndarray:
    return (token & _U(CELLS - 1)).astype(np.int64)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Lines]]:
    for part in slices(batches, "text", 1 << 20):
        yield part, Lines(part.column(part.schema.get_field_index("text")))


def _lines_and_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1: a row for each line, and at the end the token counts of the task."""
    row, sketch = TaskContext.get().partitionId() << 33, np.zeros(CELLS, np.int64)
    for part, lines in _read(batches):
        sketch += np.bincount(_cells(lines.tokens(lines.words > 0)[0]), minlength=CELLS)
        n = len(lines.key)
        yield pa.RecordBatch.from_arrays(
            [part.column(0).take(pa.array(lines.text)), pa.array(lines.text + row), pa.array(lines.place.astype(np.int32)),
             _long(lines.key), pa.array(lines.words.astype(np.int32)), pa.nulls(n, pa.binary())],
            names=["doc_id", "row", "line", "key", "words", "sketch"])
        row += part.num_rows
    packed = zlib.compress(sketch.astype("<i8").tobytes(), 1)
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(1, pa.int64()), *[pa.array([0], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int32())],
         pa.array([packed], pa.binary())], names=["doc_id", "row", "line", "key", "words", "sketch"])


def _add_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CELLS, np.int64)
    for batch in batches:
        for s in batch.column(0):
            total += np.frombuffer(zlib.decompress(s.as_buffer()), "<i8")
    yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["sketch"])


def _rarity(sketches: DataFrame):
    """The rank of each cell by the counts of all tasks, added up in two levels; an array of fixed size."""
    total = np.zeros(CELLS, np.int64)
    for r in sketches.coalesce(16).mapInArrow(_add_sketches, "sketch binary").toLocalIterator():
        total += np.frombuffer(zlib.decompress(r.sketch), "<i8")
    rank = np.empty(CELLS, np.uint64)
    rank[np.argsort(total, kind="stable")] = np.arange(CELLS)
    return sketches.sparkSession.sparkContext.broadcast(rank)


def _prefixes(rarity):
    """Step 2: (token, key, n, at) for the prefix tokens of every line, each different line once a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, lines in _read(batches):
            token, line = lines.sets(lines.first(), rarity.value)  # the rarest first
            held = np.bincount(line, minlength=len(lines.key))
            n = held[line]
            at = np.arange(len(line)) - (np.cumsum(held) - held)[line]
            use = at <= n - -(-n * NUMERATOR // DENOMINATOR)
            yield pa.RecordBatch.from_arrays(
                [_long(token[use]), _long(lines.key[line[use]]), pa.array(n[use].astype(np.int32)),
                 pa.array(at[use].astype(np.int32))], names=["token", "key", "n", "at"])

    return run


def _may_match(n, m, i, j):
    """Length and positional filter for sizes n, m of lines whose tokens i, j are the same."""
    need = -(-NUMERATOR * (n + m) // (NUMERATOR + DENOMINATOR))
    return (np.minimum(n, m) * DENOMINATOR >= np.maximum(n, m) * NUMERATOR) & (1 + np.minimum(n - i, m - j) - 1 >= need)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3: (group, key, n) for tokens that several lines share; rows come by token.

    A group's name is made of its lines' keys, so the same lines sharing many tokens are one group.  A
    token with very many rows is not held; its name is made of the token."""
    held = np.empty((4, 0), np.int64)
    passing = None  # the token whose rows are passed on as they come

    def emit(names: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [_long(names), pa.array(rows[1]), pa.array(rows[2])], names=["gid", "key", "n"])

    def closed(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        again = rows[0, 1:] == rows[0, :-1]
        if not again.any():
            return
        rows = rows[:, np.append(again, False) | np.append(False, again)]  # most tokens have one row
        rows = rows[:, np.lexsort((rows[1], rows[0]))]
        new = np.append(True, np.any(rows[:2, 1:] != rows[:2, :-1], axis=0))
        rows = rows[:, new]
        first = np.flatnonzero(np.append(True, rows[0, 1:] != rows[0, :-1]))
        size = np.diff(np.append(first, rows.shape[1]))
        good = size > 1
        a = first[size == 2]
        good[size == 2] = _may_match(rows[2, a], rows[2, a + 1], rows[3, a], rows[3, a + 1])
        names = _mix(np.add.reduceat(_mix(rows[1].view(np.uint64)), first))
        use = np.repeat(good, size)
        if use.any():
            yield emit(np.repeat(names, size)[use], rows[:, use])

    for batch in batches:
        now = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)])
        if passing is not None:
            same = now[0] == passing
            if same.any():
                yield emit(np.full(int(same.sum()), _mix(np.array([passing]).view(np.uint64))[0]), now[:, same])
                now = now[:, ~same]
            if now.shape[1]:
                passing = None
        held = np.concatenate([held, now], axis=1)
        if not held.shape[1]:
            continue
        last = int(np.searchsorted(held[0], held[0, -1]))
        yield from closed(held[:, :last])
        held = np.ascontiguousarray(held[:, last:])
        if held.shape[1] > HELD:
            passing = held[0, 0]
            yield emit(np.full(held.shape[1], _mix(held[0, :1].view(np.uint64))[0]), held)
            held = held[:, :0]
    yield from closed(held)


def _needed(keys: DataFrame):
    """A broadcast bitmap in which the bit of every key is set."""
    span = 1 << _FILTER_BLOCK

    def bits(table: pa.Table) -> pa.Table:
        on = np.zeros(span, bool)
        on[table.column("bit").to_numpy()] = True
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int64()),
                         "bits": pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())})

    bit = F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1))
    blocks = (keys.select(F.shiftright(bit, _FILTER_BLOCK).alias("block"), bit.bitwiseAND(F.lit(span - 1)).alias("bit"))
              .distinct().groupBy("block").applyInArrow(bits, "block long, bits binary"))
    bitmap = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in blocks.toLocalIterator():
        bitmap[r.block * span // 8:(r.block + 1) * span // 8] = np.frombuffer(r.bits, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bitmap)


def _token_sets(bitmap):
    """(key, tokens) of lines that are needed, each different line once a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, lines in _read(batches):
            bit = lines.key & _U(FILTER_BITS - 1)
            on = (bitmap.value[(bit >> _U(3)).astype(np.int64)] >> (bit & _U(7)).astype(np.uint8)) & 1
            token, line = lines.sets(lines.first() & (on == 1))
            owner, first = np.unique(line, return_index=True)
            cuts = np.append(first, len(token)).tolist()
            yield pa.RecordBatch.from_arrays(
                [_long(lines.key[owner]), pa.array([token[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
                names=["key", "tokens"])

    return run


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of the sets share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    token = np.concatenate(sets)
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    size = np.diff(np.append(first, len(token)))
    shared = np.zeros((len(sets), len(sets)), np.int32)
    for a, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
        own = owner[a:a + n]
        shared[own[:, None], own] += 1
    return shared


def _later(token: np.ndarray, n: np.ndarray, m: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which sets match one of a smaller rank in their tile; all tiles at once.

    ``token`` holds the sets' tokens in a row, ``n`` their numbers; tiles are runs of ``m`` sets."""
    tile, first = np.repeat(np.arange(len(m)), m), np.cumsum(m) - m
    cell = np.cumsum(m * m) - m * m  # a cell for each two sets of a tile
    place = np.arange(len(n)) - first[tile]
    owner = np.repeat(np.arange(len(n)), n)
    mixed = token + tile[owner].astype(np.uint64) * _WEIGHTS[0]
    order = np.argsort(mixed)
    mixed, own = mixed[order], owner[order]
    same = mixed[1:] == mixed[:-1]
    if np.any(same & (tile[own[1:]] != tile[own[:-1]])):
        order = np.lexsort((token, tile[owner]))
        own = owner[order]
        same = (token[order][1:] == token[order][:-1]) & (tile[own[1:]] == tile[own[:-1]])
    start = np.flatnonzero(np.append(True, ~same))
    size = np.diff(np.append(start, len(own)))
    pairs = [np.empty(0, np.int64)]
    for c in np.unique(size[size > 1]).tolist():
        some = own[start[size == c][:, None] + np.arange(c)]
        of = tile[some[:, :1]]
        i, j = np.triu_indices(c, 1)
        at = place[some]
        pairs.append((cell[of] + np.minimum(at[:, i], at[:, j]) * m[of] + np.maximum(at[:, i], at[:, j])).ravel())
    found, shared = np.unique(np.concatenate(pairs), return_counts=True)
    of = np.searchsorted(cell, found, side="right") - 1
    a, b = first[of] + (found - cell[of]) // m[of], first[of] + (found - cell[of]) % m[of]
    near = shared * DENOMINATOR >= (n[a] + n[b] - shared) * NUMERATOR
    return np.unique(np.where(rank[a] > rank[b], a, b)[near])


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 4: the keys of lines with an earlier match; a tile's rows come together."""

    def compare(sets: list[np.ndarray], rank: np.ndarray) -> np.ndarray:
        """Which sets match one of a smaller rank."""
        n = np.array([len(s) for s in sets])
        shared = _overlaps(sets)
        near = shared * DENOMINATOR >= (n[:, None] + n - shared) * NUMERATOR
        near &= rank[None] < rank[:, None]
        return np.flatnonzero(near.any(axis=1))

    def run(rows: pa.Table, cuts: list[int]) -> pa.RecordBatch:
        keys = rows.column("key").to_numpy()
        held = rows.column("tokens").cast(pa.large_binary()).combine_chunks()
        ends = np.frombuffer(held.buffers()[1], np.int64)[held.offset:held.offset + len(held) + 1] // 8
        token = np.frombuffer(held.buffers()[2], np.uint64, held.buffers()[2].size // 8)
        n = np.diff(ends)
        rank = np.empty(len(keys), int)
        rank[np.lexsort([rows.column(c).to_numpy() for c in ("line", "row", "doc")])] = np.arange(len(keys))
        cuts = np.array(cuts)
        m = np.diff(cuts)
        found = []
        for k in np.flatnonzero(m > FEW).tolist():
            a, b = cuts[k], cuts[k + 1]
            sets = [token[x:y] for x, y in zip(ends[a:b].tolist(), ends[a + 1:b + 1].tolist())]
            found.append(keys[a:b][compare(sets, rank[a:b])])
        # Runs of small tiles, cut where a tile is large or their tokens fill a block.
        few = m <= FEW
        block = (ends[cuts[:-1]] - ends[0]) // FEW_TOKENS
        new = np.append(True, (few[1:] != few[:-1]) | (block[1:] != block[:-1]))
        runs = np.append(np.flatnonzero(new), len(m))
        for x, y in zip(runs[:-1].tolist(), runs[1:].tolist()):
            if few[x]:
                a, b = cuts[x], cuts[y]
                found.append(keys[a:b][_later(token[ends[a]:ends[b]], n[a:b], m[x:y], rank[a:b])])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([keys[:0], *found]))], names=["key"])

    held: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        if not held.num_rows:
            continue
        new = np.zeros(held.num_rows - 1, bool)
        for c in ("gid", "down", "across"):
            x = held.column(c).to_numpy()
            new |= x[1:] != x[:-1]
        cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
        yield run(held.slice(0, cuts[-1]), cuts)
        held = held.slice(cuts[-1]).combine_chunks()
    if held is not None and held.num_rows:
        yield run(held, [0, held.num_rows])


def _tiles(members: DataFrame) -> DataFrame:
    """Rows of a group (gid, key, n, ...) dealt to pairs of blocks (down <= across)."""
    sizes = members.groupBy("gid").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int").alias("blocks")).where("blocks > 1")
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    rows = members.join(sizes, "gid", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return rows.withColumn("other", other).select(
        "gid", "key", F.least("own", "other").alias("down"), F.greatest("own", "other").alias("across"))


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line: (doc_id, row, line, removed).

    ``row`` tells rows with the same id apart; ``line`` counts from 0, at every line feed.  Lines are in the order of
    id (nulls first), row and line.  A line is removed if an earlier line, kept or not, has the same words or a Jaccard
    similarity of 0.8 or more.  Words end at ASCII white space and are compared as they are.  Lines
    without words are never removed; a null text is one empty line.  Ids are whole numbers; other columns
    are not read."""
    bound_batches(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    first = save(source.mapInArrow(_lines_and_sketch, "doc_id long, row long, line int, key long, words int, sketch binary"))
    rarity = _rarity(first.where("sketch is not null").select("sketch"))
    lines = first.where("sketch is null").drop("sketch")

    prefixes = source.mapInArrow(_prefixes(rarity), "token long, key long, n int, at int")
    grouped = (prefixes.repartition("token").sortWithinPartitions("token")
               .mapInArrow(_groups, "gid long, key long, n long"))
    members = save(grouped.distinct())
    keys = members.select("key").distinct()
    sets = (source.mapInArrow(_token_sets(_needed(keys)), "key long, tokens binary")
            .groupBy("key").agg(F.first("tokens").alias("tokens")))
    # A line's place is that of its first copy; one row for each copied key and task is shuffled.
    place = F.struct(F.coalesce("doc_id", F.lit(-1 << 63)).alias("doc"), "row", "line")
    firsts = save(lines.where("words > 0").groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")))
    whole = save(sets.join(firsts.select("key", "first.*"), "key").join(keys, "key", "left_semi"))
    tiles = _tiles(members).join(whole, "key")
    found = save(tiles.repartition("gid", "down", "across").sortWithinPartitions("gid", "down", "across")
                 .mapInArrow(_matches, "key long").distinct())

    # What a line needs to know is small for most lines: only keys with copies or a match are joined.
    marked = save(firsts.join(found.withColumn("matched", F.lit(True)), "key", "left")
                  .where((F.col("copies") > 1) | F.col("matched")).select("key", "first", "matched"))
    joined = lines.join(marked, "key", "left")
    gone = F.coalesce("matched", F.lit(False)) | (F.col("first").isNotNull() & ~(
        (F.col("row") == F.col("first.row")) & (F.col("line") == F.col("first.line"))))
    return joined.select(F.col("doc_id").alias(id_col), "row", "line", (gone & (F.col("words") > 0)).alias("removed"))


def deduplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_lines``, ``n_removed``, ``removed_lines`` (places, joined by commas).

    See ``duplicate_lines`` for what is removed; an empty table gives an empty result."""
    place = F.when(F.col("removed"), F.col("line"))
    return (duplicate_lines(docs, id_col, text_col).groupBy("row", id_col)
            .agg(F.count(F.lit(1)).alias("n_lines"), F.count(place).alias("n_removed"),
                 F.array_join(F.array_sort(F.collect_list(place)).cast("array<string>"), ",").alias("removed_lines"))
            .drop("row"))


def without_lines(text: F.Column, removed_lines: F.Column) -> F.Column:
    """A text without its removed lines, from ``removed_lines`` as ``deduplicate_lines`` gives it."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    gone = F.split(removed_lines, ",")
    kept = F.filter(F.transform(lines, lambda x, i: F.struct(x.alias("line"), i.cast("string").alias("at"))),
                    lambda x: ~F.array_contains(gone, x["at"]))
    return F.array_join(F.transform(kept, lambda x: x["line"]), "\n")


def brute_force(rows: list[tuple]) -> list[tuple]:
    """What ``deduplicate_lines`` returns for (id, text) rows with distinct ids, by comparing all pairs."""
    seen: list[tuple] = []
    out = []
    for i, text in sorted(rows):
        lines, gone = (text or "").split("\n"), []
        for k, line in enumerate(lines):
            words = line.encode().split()
            if not words:
                continue
            tokens = {tuple(words[j:j + SHINGLE]) for j in range(max(1, len(words) - SHINGLE + 1))}
            if any(len(tokens & t) * DENOMINATOR >= len(tokens | t) * NUMERATOR for t in seen):
                gone.append(k)
            seen.append(tokens)
        out.append((i, len(lines), len(gone), ",".join(map(str, gone))))
    return out
