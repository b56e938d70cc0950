"""Operator 13 against scoring all rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertlake.llm import negatives
from alertlake.llm.common import table
from alertlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL as SF

KIND = "vec_id long, embedding array<double>, label int, key long, score string"


def _mined(spark, rows, anchors, **how):
    df = spark.createDataFrame([(i, v, label, 1, "x") for i, label, v in rows], KIND)
    got = negatives.mine(df, F.col("vec_id").isin(*anchors), **how).collect()
    return sorted(map(str, map(tuple, got)))


def _wanted(rows, anchors, **how):
    return sorted(map(str, negatives.brute_force(rows, set(anchors), **how)))


def _vectors(seed, n, dim, labels, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    out = []
    for i in range(n):
        v = centres[rng.integers(labels)] + spread * rng.normal(size=dim)
        out.append((i, int(rng.integers(labels)), (v * rng.uniform(0.2, 3)).tolist()))
    return out


@pytest.mark.parametrize("spread,block_bytes", [(0.05, 1 << 20), (0.7, 1 << 11)])
def test_equals_brute_force(spark, spread, block_bytes):
    """Tight clusters (the lists prune) and loose ones, in small buckets and several blocks of anchors."""
    rows = _vectors(3, 260, 12, 4, spread)
    anchors = list(range(0, 260, 9))
    assert _mined(spark, rows, anchors, bucket=24, block_bytes=block_bytes) == _wanted(rows, anchors)


def test_lists_exclude_rows_and_no_match():
    """The candidates of a bucket hold every row that scores enough, and not all others."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    x = np.floor(256 * (np.eye(8)[rng.integers(8, size=500)] + 0.1 * rng.normal(size=(500, 8))))
    part = pa.table({"id": np.arange(500), "key": np.arange(500), "label": [1] * 500, "dim": pa.array([8] * 500, pa.int32()),
                     "norm": np.linalg.norm(x, axis=1), "vec": [r.tobytes() for r in x]})
    bucket = negatives._Bucket(negatives._bucket(part), 0)
    looked = 0
    for i in range(0, 500, 25):
        anchor = negatives._Anchor({"key": -1, "label": 0, "dim": 8, "norm": float(np.linalg.norm(x[i])), "vec": x[i].tobytes()})
        least = 0.9 * float(x[i] @ x[i])
        found = bucket.candidates(anchor, least)
        assert set(np.flatnonzero(x @ x[i] >= least)) <= set(found.tolist())
        looked += len(found)
    assert looked < 20 * 500 / 3
    assert len(bucket.candidates(anchor, 1e9)) == 0  # longer than any row of the bucket allows


def test_ties_nulls_repeated_rows_and_odd_vectors(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(3), [rng.choice([0.0, 0.5, 1.0]) for _ in range(3)]) for i in range(120)]  # many ties
    rows += rows[:7]  # repeated rows are rows of their own
    rows += [(None, 1, [1.0, 1.0, 1.0]), (200, None, [1.0] * 3), (201, 1, None), (202, 1, []), (203, 1, [1.0, None, 1.0]),
             (204, 1, [float("nan"), 1.0, 1.0]), (205, 1, [float("inf"), 1.0, 1.0]), (206, 1, [0.0] * 3), (207, 0, [-1.0] * 3),
             (208, 1, [1.0] * 5), (209, 2, [1.0] * 5), (210, 1, [0.5] * 5)]
    anchors = [0, 3, 50, 99, 200, 201, 202, 203, 204, 205, 206, 207, 208]
    assert _mined(spark, rows, anchors, bucket=16) == _wanted(rows, anchors)


def test_fewer_rows_than_asked_for_and_none(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 2, [0.8, 0.0]), (3, 2, [0.1, 0.0])]
    assert _mined(spark, rows, [0]) == _wanted(rows, [0]) == ["(0, 1, 1, 2, 58880, 52224)"]
    assert _mined(spark, rows, [77]) == [] and _mined(spark, rows[:1], [0]) == []
    empty = spark.createDataFrame([], KIND)
    assert negatives.mine(empty, F.col("vec_id") % 2 == 0).collect() == []


def test_large_components_stay_exact(spark):
    """Products beyond 2**53, where doubles would round."""
    big = 1e6 + 1 / 256
    rows = [(i, i % 2, [big + i / 256, 3e5 - i, 1e5 + 7 * i]) for i in range(30)]
    assert _mined(spark, rows, [0, 10], scale=1 << 11) == _wanted(rows, [0, 10], scale=1 << 11)


def test_query_equals_sql(spark):
    import duckdb

    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW embeddings AS FROM '{SF}/embeddings.parquet'")
        want = db.sql(negatives.ORACLE).fetchall()
    got = QUERIES["op13_hard_negatives"](spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_relabelled(spark):
    rows = spark.createDataFrame([(7, 9), (14, None), (8, 9), (None, 3)], "vec_id long, label int")
    assert [r.label for r in negatives.relabelled(rows).collect()] == [0, None, 9, 3]
    assert table(spark, SF, "embeddings").where("vec_id % 7 = 0").count() > 0
