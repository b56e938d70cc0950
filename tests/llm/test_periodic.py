"""Operator 12 against trying every start and period."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from alertlake.llm import periodic
from alertlake.llm.common import table
from alertlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL as SF


def _runs(text: str):
    words = periodic._Words()
    words.add_text(text.encode())
    ids, begins, _ = words.close()
    return [tuple(r) for r in periodic.runs_of_words(ids, begins).T.tolist()]


def _text(rng: random.Random, n: int, words: int) -> str:
    out = [f"w{rng.randrange(words)}" for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        a, p = rng.randrange(n), rng.randint(1, max(1, n // 5))
        for i in range(a + p, min(n, a + p * rng.randint(3, 9))):
            out[i] = out[i - p]
    return " ".join(out)


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(600):
        text = _text(rng, rng.randint(0, 400), rng.choice([1, 2, 3, 6, 40]))
        assert _runs(text) == periodic.brute_force(text)[0]


def test_texts_next_to_each_other_do_not_mix():
    rng = random.Random(6)
    texts = [_text(rng, rng.randint(0, 90), 2) for _ in range(80)] + ["a a a a", "a a a a", "", "a a a a a a"]
    words = periodic._Words()
    for t in texts:
        words.add_text(t.encode())
    ids, begins, _ = words.close()
    runs = periodic.runs_of_words(ids, begins)
    of = np.searchsorted(begins, runs[0], side="right") - 1
    for i, t in enumerate(texts):
        here = runs[:, of == i]
        assert list(zip((here[0] - begins[i]).tolist(), *here[1:].tolist())) == periodic.brute_force(t)[0]


def test_rare_words_split_until_nothing_changes():
    # b occurs four times, but only twice on each side of x; without it a is rare on the left, too.
    words = periodic._Words()
    words.add_text(b"a b a b a x b a b " + b"c d " * 4)
    ids, begins, _ = words.close()
    begin, end = periodic.surviving_segments(ids, begins)
    assert list(zip(begin.tolist(), end.tolist())) == [(9, 17)]


def test_long_texts():
    """A million equal words, long periods, and words longer than a block of text."""
    assert _runs("a " * 1_000_000) == [(0, 1_000_000, 1)]
    rng = random.Random(7)
    piece = " ".join(str(rng.randrange(10**6)) for _ in range(30_000))
    assert _runs(f"x {' '.join([piece] * 4)} y") == [(1, 120_000, 30_000)]
    assert _runs(f"x {' '.join([piece] * 3)} y") == []
    giant = "g" * (periodic.WORD_BLOCK * 2 + 5)
    assert _runs(" ".join([giant] * 6 + ["z"])) == [(0, 6, 1)]


def _planted(i, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 or not words:
        return text
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(words[j] if j < a else words[a + (j - a) % p] for j in range(n))


def _digest(i, text):
    runs, kept = periodic.brute_force(text)
    first = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (i, len(runs), *((*first, 1000 * first[1] // first[2]) if first else (None,) * 4),
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_equals_brute_force_over_the_whole_table(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    got = QUERIES["op12_periodic_runs"](spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    short = {d.doc_id for d in docs if len(d.text or "") < 40_000}
    want = {_digest(d.doc_id, _planted(d.doc_id, d.text)) for d in docs if d.doc_id in short}
    assert len(short) > 0.95 * len(docs)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(docs) and {r for r in rows if r[0] in short} == want


def test_nulls_ties_repeated_rows_and_other_columns(spark):
    rows = [(1, None, 1, "x"), (2, "", 1, "x"), (3, " \t\n\r\x0b\x0c ", 1, "x"), (None, "a b " * 6, 1, "x"), (None, "a b " * 6, 1, "x"),
            (4, "p p p p p p q q q q q q", 1, "x"), (4, "p p p p p p q q q q q q", 1, "x"), (5, "é é " * 7 + "ÿ", 1, "x"),
            (6, "a  a\ta\na\ra\x0ba", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long, runs string")
    got = periodic.digests(periodic.find_runs(docs)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(_digest(i, t)) for i, t, *_ in rows)
    named = docs.select(F.col("doc_id").alias("my.id"), F.col("text").alias("my.text"), "runs")
    assert periodic.find_runs(named, "my.id", "my.text").count() == len(rows)
    assert sorted(map(str, periodic.planted(docs).collect())) == sorted(
        f"Row(doc_id={i}, text={_planted(i, t)!r})" for i, t, *_ in rows)
    empty = docs.where("false")
    assert periodic.digests(periodic.find_runs(periodic.planted(empty))).collect() == []
