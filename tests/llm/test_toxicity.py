"""Operator 11: held-out accuracy, spellings not seen, and rows of every kind."""

import random
import zlib

import numpy as np
import pytest

from alertlake.llm import toxicity
from alertlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL as SF

BAD = ["vilewort", "grimsnod", "foulmark"]


def _corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice("bdklmnrstaeiou") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(20, 80))]
        bad = i % 4 == 0
        if bad:
            for _ in range(1 + len(words) // 12):
                words[rng.randrange(len(words))] = rng.choice(BAD)
        rows.append((i, " ".join(words), int(bad)))
    return rows


@pytest.fixture(scope="module")
def frames(spark):
    rows = _corpus(900, 1)
    docs = spark.createDataFrame([(i, t, "en", 0.5) for i, t, _ in rows], "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([(i, y, y) for i, _, y in rows], "doc_id long, toxic int, text int")
    return rows, docs, labels


def test_held_out_accuracy_and_columns(spark, frames):
    rows, docs, labels = frames
    got = toxicity.score_toxicity(docs, labels, steps=300)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == len(rows)
    truth = {i: y for i, _, y in rows}
    for r in found.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in found.values() if r.held_out]
    assert len(held) > 100
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_held_out_labels_are_not_learned(spark, frames):
    rows, docs, labels = frames
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = sorted(map(tuple, toxicity.score_toxicity(docs, labels, steps=300).collect()))
    b = sorted(map(tuple, toxicity.score_toxicity(docs, turned, steps=300).collect()))
    assert a == b  # also: two runs give the same model


def test_unseen_spellings_share_vectors(spark, frames):
    rows, docs, labels = frames
    filler = rows[1][1]
    texts = [filler] + [filler + " " + " ".join([w] * 6) for w in ("vilewortt", "grimmsnod", "foul-marks", "VILEWORT")]
    asked = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(asked)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(both, labels, steps=300).where("doc_id >= 10000").collect()}
    assert got[10_000] < 0.1 and min(got[10_000 + i] for i in range(1, len(texts))) > 0.3, got


def test_rows_of_every_kind(spark, frames):
    _, docs, labels = frames
    odd = spark.createDataFrame([(None, None), (None, "x y"), (5000, ""), (5000, ""), (5001, "… --"), (5002, "q" * 100_000),
                                 (5003, "ab " * 400_000), (5004, "\U0001f600 é ß İ")], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(odd)
    extra = labels.select("doc_id", "toxic").unionByName(
        spark.createDataFrame([(None, 1), (1, None), (0, 0), (999_999, 1)], "doc_id long, toxic int"))
    got = toxicity.score_toxicity(both, extra, steps=100).where("doc_id >= 5000 or doc_id is null").collect()
    assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)
    assert all(not r.held_out for r in got if r.doc_id is None)
    assert len({r.score for r in got if r.doc_id in (5000, 5001)}) == 1  # no words
    assert toxicity.score_toxicity(docs.where("false"), labels, steps=10).collect() == []
    unlabelled = toxicity.score_toxicity(odd, labels.where("false")).collect()
    assert [(r.score, r.predicted) for r in unlabelled] == [(0.0, 0)] * 8


def test_bags_in_blocks_equal_whole(monkeypatch):
    text = " ".join(_corpus(40, 2)[i][1] for i in range(40)) + " " + "z" * 1000
    whole = toxicity._count_words(text)
    rows, weights = toxicity.bag(text)
    monkeypatch.setattr(toxicity, "BLOCK", 50)
    monkeypatch.setattr(toxicity, "TOGETHER", 7)
    assert toxicity._count_words(text) == whole and sum(whole.values()) == len(toxicity._WORD.findall(text))
    again, again_weights = toxicity.bag(text)
    assert (rows == again).all() and np.allclose(weights, again_weights) and abs(weights.sum() - 1) < 1e-4


def test_training_follows_the_loss():
    """A step's slopes equal differences of the loss, for rows of the table and for the outputs."""
    rng = np.random.default_rng(0)
    table, outputs = rng.normal(size=(5, 3)), rng.normal(size=(3, 2))
    w, y = rng.uniform(size=(4, 5)), np.array([0, 1, 1, 0])

    def loss(t, o):
        z = w @ t @ o
        z -= z.max(axis=1, keepdims=True)
        return -np.mean(z[np.arange(4), y] - np.log(np.exp(z).sum(axis=1)))

    z = w @ table @ outputs
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    wrong = (p[:, 1] - y) / 4
    pull = w.T @ wrong
    for slope, which in ((pull[:, None] * (outputs[:, 1] - outputs[:, 0]), 0), (np.stack([-(pull @ table), pull @ table], 1), 1)):
        for at in np.ndindex(slope.shape):
            both = [table.copy(), outputs.copy()]
            both[which][at] += 1e-6
            assert abs((loss(*both) - loss(table, outputs)) / 1e-6 - slope[at]) < 1e-4


def test_query_on_held_out_documents(spark):
    """Labels are noisy: 7 of 100 toxic documents hold no insult, 3 of 100 clean ones do."""
    folder = SF.replace("0.001", "0.1")
    got = QUERIES["op11_toxicity"](spark, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    clean = [r.predicted for r in held if not labels[r.doc_id]]
    toxic = [r.predicted for r in held if labels[r.doc_id]]
    assert np.mean(clean) < 0.05 and np.mean(toxic) > 0.8, (np.mean(clean), np.mean(toxic))
