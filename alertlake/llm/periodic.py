"""Periodic runs of words, found by recursive frequency splitting.

A run is a stretch of words with a smallest period q, at least ``REPEATS`` periods and ``SHORTEST``
words long, that cannot be extended.  Each of its words occurs at least ``REPEATS`` times in it, so a
word that occurs less often within its segment is part of no run there: it splits the segment.  The
pieces are counted again, until no piece is split any more.  What survives is small, save in texts
that do repeat themselves.

The surviving segments are scanned lag by lag.  Short lags are compared word by word.  Lags from b
to 2b, for each power of two b, are compared by blocks of b words: a run of such a period spans two
consecutive blocks that begin at multiples of b, and equals itself there at that lag.  So one
comparison of all blocks with the block b before covers all b lags, and only lags that agree on
two blocks are looked at word by word.  That takes n log n steps, also for a text of one word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake.llm.common import bound_batches, slices

#: A run is at least so many periods and so many words long.
REPEATS = 4
SHORTEST = 6
#: Lags below this are compared word by word (a power of two).
SHORT_LAG = 16
#: Bytes of text that are cut into words together.
WORD_BLOCK = 1 << 20
WHITE = b" \t\n\r\x0b\x0c"
_BASE = 0x9E3779B97F4A7C15
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


# ---------------------------------------------------------------- words

class _Words:
    """The words of some texts in a row, as numbers into a list of the different ones."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.sizes: list[int] = []

    def _add(self, piece: bytes) -> int:
        coded = pa.array(piece.split(), pa.binary()).dictionary_encode()
        known = self.number
        names = np.fromiter((known.setdefault(w, len(known)) for w in coded.dictionary.to_pylist()), np.int32,
                            len(coded.dictionary))
        if len(names):
            self.parts.append(names[coded.indices.to_numpy()])
        return len(coded)

    def add_text(self, text: bytes) -> None:
        """Cut a text into words; a long one goes in blocks that end at white space."""
        held, at = 0, 0
        while len(text) - at > WORD_BLOCK:
            end = max(text.rfind(w, at, at + WORD_BLOCK) for w in (WHITE[i:i + 1] for i in range(len(WHITE))))
            if end <= at:  # one word longer than a block
                end = min((e for e in (text.find(WHITE[i:i + 1], at + WORD_BLOCK) for i in range(len(WHITE))) if e >= 0),
                          default=len(text))
            held += self._add(text[at:end])
            at = end
        self.sizes.append(held + self._add(text[at:]))

    def close(self) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Word numbers, where each text begins (and the end), and the different words."""
        ids = np.concatenate(self.parts) if self.parts else np.empty(0, np.int32)
        return ids, np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)]), pa.array(list(self.number), pa.binary())


# ---------------------------------------------------------------- splitting

def surviving_segments(ids: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the segments that no word splits: each occurs ``REPEATS`` times in its segment."""
    begin, end = begins[:-1], begins[1:]
    width = int(ids.max()) + 1 if len(ids) else 1
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        long = end - begin >= SHORTEST
        begin, end = begin[long], end[long]
        if not len(begin):
            break
        size = end - begin
        of = np.repeat(np.arange(len(begin)), size)
        at = np.arange(len(of)) + (begin - (np.cumsum(size) - size))[of]
        _, word, times = np.unique(of * width + ids[at], return_inverse=True, return_counts=True)
        stays = times[word] >= REPEATS
        whole = np.bincount(of[~stays], minlength=len(begin)) == 0
        done.append((begin[whole], end[whole]))
        again = stays & ~whole[of]
        at, of = at[again], of[again]
        if not len(at):
            break
        cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(of) != 0))
        begin, end = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + 1
    if not done:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begin, end = (np.concatenate(c).astype(np.int64) for c in zip(*done))
    order = np.argsort(begin)
    return begin[order], end[order]


# ---------------------------------------------------------------- lag scan

def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).view(np.int8)))
    return edges[::2], edges[1::2]


def _short_lags(words: np.ndarray, most: int) -> np.ndarray:
    """Runs (start, end, period) of all periods below ``SHORT_LAG``, smallest periods only."""
    found, seen = [], np.empty(0, np.int64)
    for q in range(1, min(SHORT_LAG, most + 1)):
        start, stop = _stretches(words[q:] == words[:-q])
        long = stop - start + q >= max(SHORTEST, REPEATS * q)
        start, stop = start[long], stop[long] + q
        span = start * (len(words) + 1) + stop
        new = ~np.isin(span, seen)  # a multiple of a smaller period has the same span
        seen = np.concatenate([seen, span[new]])
        found.append(np.stack([start[new], stop[new], np.full(int(new.sum()), q)]))
    return np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)


class _Blocks:
    """Names of all blocks of a given number of words: equal blocks have equal names.

    Names are polynomials modulo 2**64; two different blocks may share one, which costs a look."""

    def __init__(self, words: np.ndarray):
        mixed = (words.astype(np.int64).view(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(32)
        n = len(words)
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed * power[:-1], out=self.sums[1:])
        self.back = np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        self.back[0] = 1
        np.cumprod(self.back, out=self.back)

    def names(self, b: int) -> np.ndarray:
        return (self.sums[b:] - self.sums[:-b]) * self.back[:len(self.sums) - b]


def _chains(names: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lag, begin, end): stretches of blocks that equal, at a lag from b to 2b, the words lag after them."""
    rows = -(-len(names) // b)
    if rows < 3:
        return (np.empty(0, np.int64),) * 3
    filler = np.arange(rows * b - len(names), dtype=np.uint64) * np.uint64(_BASE)  # equal to no block
    grid = np.concatenate([names, filler]).reshape(rows, b)
    equal = grid[1:] == grid[:-1, :1]
    rest, block = np.nonzero((equal[:-1] & equal[1:]).T)
    if not len(rest):
        return (np.empty(0, np.int64),) * 3
    cut = np.flatnonzero((np.diff(rest) != 0) | (np.diff(block) != 1))
    first, last = np.append(0, cut + 1), np.append(cut, len(rest) - 1)
    return rest[first] + b, block[first] * b, (block[last] + 2) * b


def _long_lags(words: np.ndarray, most: int, runs: list[tuple[int, int, int]]) -> None:
    """Add the runs of all periods from ``SHORT_LAG`` to ``most`` to those of smaller ones."""
    blocks, b = _Blocks(words), SHORT_LAG
    spans = {(s, e) for s, e, _ in runs}
    while b <= most:
        lag, begin, end = _chains(blocks.names(b), b)
        order = np.argsort(begin, kind="stable")
        lag, begin, end = lag[order], begin[order], end[order]
        new = lag <= most
        # Inside a run, the multiples of its period give the run itself again.
        for s, e, p in runs:
            if e - s >= REPEATS * b and len(begin):
                here = slice(*np.searchsorted(begin, [s, e]))
                new[here] &= (lag[here] % p != 0) | (end[here] + lag[here] > e)
        for q, at, to in zip(lag[new].tolist(), begin[new].tolist(), end[new].tolist()):
            low, high = max(0, at - b), min(len(words) - q, to + b)
            for start, stop in zip(*_stretches(words[low:high] == words[low + q:high + q])):
                s, e = low + int(start), low + int(stop) + q
                if e - s >= REPEATS * q and (s, e) not in spans:
                    spans.add((s, e))
                    runs.append((s, e, q))
        b *= 2


def runs_of_words(ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """All runs as columns (start, length, period), by start, then period; starts count over all texts."""
    seg_begin, seg_end = surviving_segments(ids, begins)
    if not len(seg_begin):
        return np.empty((3, 0), np.int64)
    size = seg_end - seg_begin
    # The segments in a row, each followed by a word of its own.
    place = np.cumsum(size + 1) - (size + 1)
    words = np.repeat(-1 - np.arange(len(size)), size + 1)
    of = np.repeat(np.arange(len(size)), size)
    inside = np.arange(len(of)) - (np.cumsum(size) - size)[of]
    words[place[of] + inside] = ids[seg_begin[of] + inside]
    most = int(size.max()) // REPEATS
    short = _short_lags(words, most)
    if most >= SHORT_LAG:
        runs = list(zip(*(c.tolist() for c in short)))
        _long_lags(words, most, runs)
        short = np.array(runs, np.int64).reshape(-1, 3).T
    start, end, period = short
    segment = np.searchsorted(place, start, side="right") - 1
    start, length = start - place[segment] + seg_begin[segment], end - start
    order = np.lexsort((period, start))
    return np.stack([start[order], length[order], period[order]])


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words no run contains after its first period."""
    start, length, period = runs
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return np.cumsum(depth[:-1]) == 0


# ---------------------------------------------------------------- Spark

def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for part in slices(batches, "text"):
        words = _Words()
        for text in part.column("text").cast(pa.binary()):
            words.add_text(text.as_py() or b"")
        ids, begins, names = words.close()
        runs = runs_of_words(ids, begins)
        keep = kept_words(len(ids), runs)
        of = np.searchsorted(begins, runs[0], side="right") - 1
        inside = pa.StructArray.from_arrays([pa.array(runs[0] - begins[of]), pa.array(runs[1]), pa.array(runs[2])],
                                            fields=list(kind))
        found = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(of, np.arange(len(begins))), pa.int32()), inside)
        ends = np.concatenate([[0], np.cumsum(keep)])[begins]
        kept = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), names.take(pa.array(ids[keep])))
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(np.diff(begins)), found, pc.binary_join(kept, b" ").cast(pa.string())],
            names=["id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``runs`` (structs of start, length and period, by
    start, then period) and ``collapsed``, the text without the words that repeat a run's first period.

    Words are separated by ASCII white space; in ``collapsed`` by one space.  A null text counts as empty: no
    words, no runs, an empty ``collapsed``.  Rows are treated one by one, so repeated rows and null ids
    stay as they are.  Other columns are not read, whatever their names; an empty table gives an empty
    result.  A text is read whole, however long: beyond its words' numbers, a task holds a few numbers a word."""
    bound_batches(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_find, f"id {kind}, n_words long, runs {RUNS}, collapsed string").withColumnRenamed(
        "id", id_col)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): texts by ``docs``, a tenth of them made periodic from some word on.

    With h the CRC-32 of the id in decimal and g = h // 10: where h % 10 = 0 and there are n > 0 words,
    the words from a = g % n on repeat the first 1 + (n - a) // (3 + g % 8) of them.  A null id plants nothing."""
    h = F.crc32(F.col(f"`{id_col}`").cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.col(f"`{text_col}`"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), again)), F.lit(1), n - a)
    text: Column = F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).otherwise(
        F.col(f"`{text_col}`"))
    return docs.select(F.col(f"`{id_col}`").alias(id_col), text.alias(text_col))


def digests(runs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The number of runs, the longest one (ties: smallest start, then period), and SHA-256 sums of all."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return runs.select(
        F.col(f"`{id_col}`").alias(id_col), F.size("runs").cast("long").alias("n_runs"), longest.alias("l"),
        F.sha2(F.encode(listed, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256")).select(
        f"`{id_col}`", "n_runs", (-F.col("l.start")).alias("start"), F.col("l.length").alias("length"),
        (-F.col("l.period")).alias("period"),
        F.floor(F.col("l.length") * 1000 / -F.col("l.period")).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


def brute_force(text: str | None) -> tuple[list[tuple[int, int, int]], str]:
    """The runs and the collapsed text of one text, by trying every start and period."""
    words = [w.decode() for w in (text or "").encode().split()]
    n, runs = len(words), []
    for q in range(1, n // REPEATS + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(SHORTEST, REPEATS * q):
                part = words[i:j + q]
                if not any(part[k:] == part[:-k] for k in range(1, q)):
                    runs.append((i, j - i + q, q))
            i = j + 1
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    return sorted(runs, key=lambda r: (r[0], r[2])), " ".join(w for i, w in enumerate(words) if i not in drop)
