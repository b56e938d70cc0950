"""SimHash against comparison of all pairs."""

import random
from itertools import combinations

import pytest

from alertlake.llm import simhash
from alertlake.llm.components import components

DOCS = "doc_id long, text string, fingerprint string"


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.covering_masks(3)
    assert len(masks) == 15
    for places in combinations(range(64), 3):
        differ = sum(1 << p for p in places)
        assert any(not m & differ for m in masks)


def _docs():
    random.seed(3)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(random.choices(words, k=120)) for _ in range(12)]
    rows = []
    for i in range(150):
        t = base[i % 12].split()
        for _ in range(random.choice([0, 0, 1, 2, 6])):
            t[random.randrange(len(t))] = random.choice(words)
        rows.append(" ".join(t))
    rows += ["", None, " \t\n", "one", "ONE", "one two", "One\x0btwo", "É", "é", "a\u00a0b", "x " * 20_000]
    return [(100 - i if i < 100 else i + 5, t, "clash") for i, t in enumerate(rows)]


@pytest.mark.parametrize("radius", [3, 6])
def test_near_duplicates_equal_brute_force(spark, radius):
    rows = _docs()
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted(tuple(r) for r in simhash.near_duplicates(docs, radius=radius).collect())
    assert got == sorted(simhash.brute_force([r[:2] for r in rows], radius=radius))
    assert len({r[2] for r in got}) < len({r[1] for r in got}), "some different fingerprints are linked"


@pytest.mark.parametrize("run,votes", [(1, 1), (7, 30), (1 << 18, 1 << 17)])
def test_votes_of_runs_are_those_of_whole_texts(monkeypatch, run, votes):
    monkeypatch.setattr(simhash, "RUN_BYTES", run)
    monkeypatch.setattr(simhash, "VOTES", votes)
    rows = [r[:2] for r in _docs() if len(r[1] or "") < 2000]
    want = [p for _, p, _ in simhash.brute_force(rows)]
    assert [f"{p:016x}" for p in simhash._fingerprints([t for _, t in rows], 3).tolist()] == want


def test_a_long_text_takes_few_times_its_own_memory():
    import tracemalloc

    text = " ".join(f"w{i % 9973}" for i in range(800_000))
    tracemalloc.start()
    assert simhash._fingerprints([text], 3)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20 and len(text) > 4 << 20


def test_full_buckets_are_split_without_loss(spark):
    random.seed(4)
    centre = random.getrandbits(64)
    prints = {centre}
    while len(prints) < 500:
        x = centre
        for _ in range(random.randrange(1, 7)):
            x ^= 1 << random.randrange(64)
        prints.add(x)
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints], "print long")
    links = [(a & simhash.ALL, b & simhash.ALL) for a, b in
             ((r.a, r.b) for r in simhash.print_links(frame, bucket=16).collect())]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)

    def classes(pairs):
        of = {p: p for p in prints}

        def root(x):
            while of[x] != x:
                of[x] = of[of[x]]
                x = of[x]
            return x

        for a, b in pairs:
            of[root(a)] = root(b)
        out = {}
        for p in prints:
            out.setdefault(root(p), set()).add(p)
        return sorted(map(sorted, out.values()))

    every = [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 3]
    assert classes(links) == classes(every)


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c d", "x"), (1, "a b c d", "x"), (2, "a b c d", "y"), (None, "a b c d", "z")], DOCS)
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {1}
    assert [r.doc_id for r in simhash.keep_one(docs).dropDuplicates().collect() if r.doc_id is not None] == [1]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_keep_one_keeps_one_row_of_each_group(spark):
    near = "a b c d"
    rows = [(1, near, "x"), (1, near, "x"), (2, near, "y"), (None, near, "z"), (None, "only null ids", "u"), (None, "only null ids", "u"),
            (7, near, "repeated id, near row 1"), (7, "another text with the id of that row", "v"), (8, "e f g h", "w")]
    got = simhash.keep_one(spark.createDataFrame(rows, DOCS))
    assert got.columns == ["doc_id", "text", "fingerprint"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(1, near), (None, "only null ids"), (7, "another text with the id of that row"), (8, "e f g h")], key=str)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(10, 60)]
    star = [(200, i) for i in range(201, 260)] + [(5, 5)]
    frame = spark.createDataFrame(path + star + path[:3], "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == {**{i: 10 for i in range(10, 61)}, **{i: 200 for i in range(200, 260)}}
