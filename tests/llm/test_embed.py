"""Embedding near-duplicates against comparison of all pairs."""

import random

import pytest

from alertlake.llm import embed

VECTORS = "vec_id long, label int, embedding array<float>, n_links string"


def _rows():
    random.seed(8)
    rows = []
    for c in range(40):
        centre = [random.gauss(0, 1) for _ in range(12)]
        for _ in range(random.choice([1, 2, 9])):
            rows.append((random.choice([0, 0, 0, 1]), [x + random.gauss(0, 0.15) for x in centre]))
    rows += [rows[0]] * 25 + [(0, [2 * x for x in rows[0][1]])]
    rows += [(0, None), (0, []), (0, [0.0] * 12), (0, [1.0, None] + [0.0] * 10), (0, [float("nan")] + [1.0] * 11),
             (0, [float("inf")] + [1.0] * 11), (None, rows[0][1]), (0, [1.0, 0.0]), (0, [1.0, -0.0]), (1, [3e38, 3e38, 1e-38])]
    return [(i * 7 % 1009, label, vec) for i, (label, vec) in enumerate(rows)]


def _single(vec):
    import numpy as np
    return None if vec is None else [None if x is None else float(np.float32(x)) for x in vec]


@pytest.mark.parametrize("block", [embed.BLOCK, 16])
def test_links_equal_brute_force(spark, block):
    rows = _rows()
    frame = spark.createDataFrame([(*r, "clash") for r in rows], VECTORS)
    got = sorted(tuple(r) for r in embed.near_duplicates(frame, block=block).collect())
    want = sorted(embed.brute_force([(i, label, _single(v)) for i, label, v in rows]))
    assert got == want
    assert any(r[1] >= 25 for r in got)


def test_pivots_leave_far_cells_out(spark):
    import numpy as np
    import pyarrow as pa

    class Held:
        value = {(0, 3): np.eye(3)}

    vecs = np.array([[1, 0.01, 0], [1, 0.99, 0], [0, 0, 5]], "<f4")
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3]), pa.array([1, 1, 1]), pa.array([0, 0, 0], pa.int32()), pa.array([3, 3, 3], pa.int32()),
         pa.array([v.tobytes() for v in vecs], pa.binary())], names=["class", "n", "label", "dim", "vec"])
    out = [(r["class"], r["cell"], r["home"]) for b in embed._cells(Held, "<f4", 0.37)(iter([batch])) for r in b.to_pylist()]
    assert sorted(out) == [(1, 0, True), (2, 0, True), (2, 1, False), (3, 2, True)]


def test_cells_by_steps_equal_those_of_all_distances(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 6))
    centres[1] = centres[0] + 1e-9  # close pivots
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    vecs = rng.normal(size=(200, 6)).astype("<f4")

    class Held:
        value = {(0, 6): centres}

    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(200)), pa.array([1] * 200), pa.array([0] * 200, pa.int32()), pa.array([6] * 200, pa.int32()),
         pa.array([v.tobytes() for v in vecs], pa.binary())], names=["class", "n", "label", "dim", "vec"])
    monkeypatch.setattr(embed, "PRODUCTS", 100)
    got = {(r["class"], r["cell"]): r["home"] for b in embed._cells(Held, "<f4", 0.37)(iter([batch])) for r in b.to_pylist()}
    x = vecs.astype(float)
    dots = x / np.linalg.norm(x, axis=1, keepdims=True) @ centres.T
    for i, own in enumerate(dots.argmax(axis=1).tolist()):
        assert got[(i, own)]
        for j in range(30):
            far = j != own and (dots[i, own] - dots[i, j]) / np.linalg.norm(centres[own] - centres[j]) > 0.37 + 1e-5
            assert ((i, j) in got) != far or not far
    assert len(got) < 200 * 20


def test_empty_table_and_repeated_ids(spark):
    frame = spark.createDataFrame([], VECTORS)
    assert embed.near_duplicates(frame).count() == 0
    twice = spark.createDataFrame([(1, 0, [1.0, 2.0], "x")] * 2 + [(None, 0, [1.0, 2.0], "x")], VECTORS)
    assert sorted(map(str, (tuple(r) for r in embed.near_duplicates(twice).collect()))) == [
        "(1, 2, 1, True)", "(1, 2, 1, True)", "(None, 2, 1, False)"]
