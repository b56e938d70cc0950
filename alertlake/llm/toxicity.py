"""Toxicity by subword-bag embeddings and a linear softmax.

A word is the mean of the vectors of its character n-grams (with marks for its beginning and end) and of its
own vector, all hashed to rows of one table; a text is the mean of its words; two linear outputs and a
softmax tell toxic from clean.  The table and the outputs are trained together, in numpy.  An unseen spelling
shares most n-grams with the spelling it comes from, hence most of its vector.

Training takes place in one task, on a bounded sample of the labelled documents, which it turns into bags of
rows one by one.  As the outputs are linear, a trained model comes down to one
number for each row of the table, and a word's part in a text's score to the mean of a few of them.
Scoring reads every text whole, in blocks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake.llm.common import bound_batches, give_back, save, slices

#: Rows of the table, and numbers in a row.
ROWS = 1 << 17
WIDTH = 8
#: Lengths of n-grams.
NGRAMS = (3, 4, 5)
#: The training sample: at most so many labelled documents, those with the smallest hash of their id, and of
#: these as many as have this many rows in their bags altogether.
MAX_FIT = 10_000
MAX_FIT_ROWS = 30_000_000
#: Steps of training, whatever the sample, and texts in a step.
STEPS = 1200
BATCH = 128
RATE = 0.1
#: What pulls the table towards 0, over the texts of the sample.
DECAY = 0.02
#: From this score on a text is taken for toxic.
THRESHOLD = 0.3
#: Characters of a text that are cut into words together, words that are hashed together, words that are remembered.
BLOCK = 1 << 20
TOGETHER = 20_000
KNOWN = 200_000

#: A run of over 200 letters and digits counts as several words.
_WORD = re.compile(r"[^\W_]{1,200}")
_REST = re.compile(r"[^\W_]+")


# ---------------------------------------------------------------- bags

def _word_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of words, and the words (by place) that they belong to."""
    marked = [f"<{w}>" for w in words]
    size = np.array([len(w) for w in marked])
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    of = np.repeat(np.arange(len(words)), size)
    left = np.cumsum(size)[of] - np.arange(len(points))  # characters from here to the word's end
    rows = [np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)]
    owner = [np.arange(len(words))]
    state = np.zeros(len(points), np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        state = state[:len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1:] + np.uint64(n)
        if n in NGRAMS:
            at = np.flatnonzero(left[:len(state)] >= n)
            rows.append(state[at])
            owner.append(of[at])
    row = np.concatenate(rows)
    row = ((row ^ (row >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - ROWS.bit_length() + 1)
    return row.astype(np.int32), np.concatenate(owner)


def _count_words(text: str) -> Counter:
    """Words of a text in lower case (runs of letters and digits) and how often; a long text goes in blocks."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        end = min(at + BLOCK, len(text))
        cut = _REST.match(text, end) if text[end - 1].isalnum() else None
        end = cut.end() if cut else end
        found.update(_WORD.findall(text[at:end].lower()))
        at = end
    return found


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a text and their weights, which add up to 1 (no words: none)."""
    counts = _count_words(text)
    words, total = list(counts), sum(counts.values())
    held_rows, held = np.empty(0, np.int32), np.empty(0)
    for at in range(0, len(words), TOGETHER):
        part = words[at:at + TOGETHER]
        rows, owner = _word_rows(part)
        share = np.array([counts[w] for w in part]) / (total * np.bincount(owner))
        held_rows, place = np.unique(np.concatenate([held_rows, rows]), return_inverse=True)
        held = np.bincount(place, np.concatenate([held, share[owner]]))
    return held_rows, held.astype(np.float32)


# ---------------------------------------------------------------- training

def train(rows: np.ndarray, weights: np.ndarray, size: np.ndarray, toxic: np.ndarray,
          steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Each row's part in the log-odds of toxic, and what every text starts from.

    Bags stand one after another in ``rows`` and ``weights``, ``size`` of them for each text.  The table and the two
    outputs are trained together by Adam on the softmax's loss.  With two outputs the loss pulls every row of the
    table along one direction, the difference of the outputs, so a step needs one number for each row."""
    rng = np.random.default_rng(7)
    seen = np.flatnonzero(np.bincount(rows, minlength=1))  # the other rows are in no bag and say nothing
    rows = np.searchsorted(seen, rows).astype(np.int32)
    table = rng.uniform(-0.01, 0.01, (len(seen), WIDTH)).astype(np.float32)
    outputs = rng.normal(0, 1, (WIDTH, 2)).astype(np.float32)
    bias = np.array([0.0, np.log((toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 0.5))], np.float32)
    learned = [table, outputs, bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in learned]
    begin = np.cumsum(size) - size
    order = np.empty(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < BATCH:
            order = np.concatenate([order, rng.permutation(len(size))])
        own, order = order[:BATCH], order[BATCH:]
        n = size[own]
        of = np.repeat(np.arange(len(own)), n)
        place = np.arange(len(of)) + (begin[own] - (np.cumsum(n) - n))[of]
        row, weight = rows[place], weights[place]
        logits = np.stack([np.bincount(of, weight * (table @ outputs[:, k])[row], len(own)) + bias[k] for k in (0, 1)])
        logits -= logits.max(axis=0)
        p = np.exp(logits)
        p /= p.sum(axis=0)
        wrong = (p - np.stack([1 - toxic[own], toxic[own]])) / len(own)  # of each output; they add up to 0
        pull = np.bincount(row, weight * wrong[1][of], len(seen)).astype(np.float32)
        slope = [pull[:, None] * (outputs[:, 1] - outputs[:, 0]) + DECAY / len(size) * table,
                 np.stack([-(pull @ table), pull @ table], axis=1), wrong.sum(axis=1)]
        rate = RATE * (1 - step / (steps + 1)) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        for part, g, (m, v) in zip(learned, slope, moments):
            g = g.astype(np.float32)
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            part -= rate * m / (np.sqrt(v) + 1e-8)
    apart = outputs[:, 1] - outputs[:, 0]
    parts = np.zeros(ROWS, np.float32)
    parts[seen] = table @ apart
    return parts, float(bias[1] - bias[0])


def _fit(steps: int):
    """The model of the texts given, in order, up to ``MAX_FIT_ROWS`` rows of bags."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, weights = np.empty(MAX_FIT_ROWS, np.int32), np.empty(MAX_FIT_ROWS, np.float32)  # memory as it is filled
        size, toxic, held = [], [], 0
        for part in slices(batches, "text"):
            for text, label in zip(part.column("text"), part.column("toxic").to_pylist()):
                row, weight = bag(text.as_py() or "")
                if held + len(row) > MAX_FIT_ROWS:
                    continue
                rows[held:held + len(row)], weights[held:held + len(row)] = row, weight
                size.append(len(row))
                toxic.append(label)
                held += len(row)
        if size:
            parts, start = train(rows[:held], weights[:held], np.array(size), np.array(toxic), steps)
            yield pa.RecordBatch.from_arrays([pa.array([parts.tobytes()], pa.binary()), pa.array([start])],
                                             names=["parts", "start"])
        del rows, weights
        give_back()

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", steps: int = STEPS) -> DataFrame:
    """A table of one row (``parts``, ``start``), or none if no document is labelled.

    A document whose labels differ is toxic.  Only documents of the sample are read as texts; of rows of ``docs``
    with one id, the one whose text has the smallest hash counts."""
    named = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic")).dropna()
    mark = F.xxhash64("id")
    chosen = (named.groupBy("id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
              .join(docs.select(F.col(f"`{id_col}`").alias("id")), "id", "left_semi")
              .select(mark.alias("mark"), "id", "toxic").orderBy("mark", "id").limit(MAX_FIT))
    # MAX_FIT ids at most.
    sample = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(
        F.broadcast(save(chosen)), "id")
    one = F.min_by(F.struct("toxic", "text"), F.xxhash64("text")).alias("d")
    texts = sample.groupBy("mark", "id").agg(one).select("mark", "id", "d.toxic", "d.text")
    return save(texts.repartition(1).sortWithinPartitions("mark", "id").mapInArrow(_fit(steps), "parts binary, start double"))


# ---------------------------------------------------------------- scoring

class _Scorer:
    def __init__(self, parts: np.ndarray, start: float):
        self.parts, self.start = parts, start
        self.known: dict[str, float] = {}

    def _of_words(self, words: list[str]) -> dict[str, float]:
        if len(self.known) > KNOWN:
            self.known = {}
        new = [w for w in words if w not in self.known]
        for at in range(0, len(new), TOGETHER):
            part = new[at:at + TOGETHER]
            rows, owner = _word_rows(part)
            self.known.update(zip(part, (np.bincount(owner, self.parts[rows]) / np.bincount(owner)).tolist()))
        return self.known

    def scores(self, texts: list[str]) -> np.ndarray:
        counts = [_count_words(t) for t in texts]
        value = self._of_words(list(set().union(*counts)))
        odds = [self.start + (sum(n * value[w] for w, n in c.items()) / sum(c.values()) if c else 0.0) for c in counts]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, start = model.value
        scorer = _Scorer(np.frombuffer(parts, np.float32), start)
        for part in slices(batches, "text"):
            scores = scorer.scores([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("held_out"), pa.array(scores)],
                                             names=["id", "held_out", "score"])

    return run


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row's label is never learned from: the CRC-32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 4 == 2, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", threshold: float = THRESHOLD, steps: int = STEPS) -> DataFrame:
    """One row per row of ``docs``: its id, ``held_out``, ``score`` from 0 to 1, and ``predicted``, 1 from ``threshold`` on.

    The model learns from labelled rows that are not held out (see ``held_out`` and ``fit``).  Null and empty texts, and
    texts without words, score what the share of toxic documents makes of them.  Null ids have no label and are
    scored like others; repeated rows are scored one by one.  Null labels are not learned.  Without labels to
    learn from all scores are 0.  Other columns are not read; an empty table gives an empty result."""
    spark = docs.sparkSession
    bound_batches(spark)
    learn = labels.where(~held_out(id_col))
    model = fit(docs, learn, id_col, text_col, label_col, steps).first()
    source = docs.select(F.col(f"`{id_col}`").alias("id"), held_out(id_col).alias("held_out"),
                         F.col(f"`{text_col}`").alias("text"))
    if model is None:
        scored = source.select("id", "held_out", F.lit(0.0).alias("score"))
    else:
        # One number for each of ROWS rows, whatever the corpus.
        sent = spark.sparkContext.broadcast((bytes(model.parts), model.start))
        kind = source.schema["id"].dataType.simpleString()
        scored = source.mapInArrow(_score(sent), f"id {kind}, held_out boolean, score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
