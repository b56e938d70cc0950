"""Line dedup against comparison of all pairs."""

import random

import pytest

from alertlake.llm import linededup

DOCS = "doc_id long, text string, line string, key string"


def _docs():
    random.seed(9)
    words = [f"w{i}" for i in range(300)]
    base = [random.choices(words, k=random.choice([3, 5, 8, 30, 60])) for _ in range(40)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(random.randrange(1, 7)):
            line = list(random.choice(base)) if random.random() < 0.6 else random.choices(words, k=random.randrange(40))
            for _ in range(random.choice([0, 0, 1, 2])):
                if line:
                    line[random.randrange(len(line))] = random.choice(words)
            lines.append(random.choice([" ", "  ", "\t"]).join(line))
        rows.append("\n".join(lines))
    rows += [None, "", "\n\n", "a\r\nb", "a", "A", " a ", "x y " * 20_000, "x y " * 19_000, "é \xa0 é"]
    return [(500 - i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("block", [linededup.BLOCK, 3])
def test_removed_lines_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(linededup, "BLOCK", block)
    rows = _docs()
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], DOCS).repartition(4)
    got = linededup.deduplicate_lines(docs)
    want = linededup.brute_force(rows)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert sum(r[2] for r in want) > 100
    whole = docs.join(got, "doc_id").select("doc_id", linededup.without_lines(docs.text, got.removed_lines).alias("t"))
    gone = {r[0]: set(filter(None, r[3].split(","))) for r in want}
    assert {r.doc_id: r.t for r in whole.collect()} == {
        i: "\n".join(x for k, x in enumerate((t or "").split("\n")) if str(k) not in gone[i]) for i, t in rows}


def test_rows_of_a_very_common_token_are_not_held(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(linededup, "HELD", 10)
    rows = [(1, k) for k in range(2)] + [(5, k) for k in range(95)] + [(6, 1), (7, 1), (7, 2)]
    batches = [pa.RecordBatch.from_arrays(
        [pa.array([t for t, _ in part]), pa.array([k for _, k in part]), pa.array([9] * len(part), pa.int32()),
         pa.array([0] * len(part), pa.int32())], names=["token", "key", "n", "at"])
        for part in (rows[i:i + 8] for i in range(0, len(rows), 8))]
    out = [tuple(r.values()) for b in linededup._groups(iter(batches)) for r in b.to_pylist()]
    sizes = sorted(sum(1 for r in out if r[0] == g) for g in {r[0] for r in out})
    assert sizes == [2, 2, 95]


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b\nc", "x", "y")] * 2 + [(None, "a b\nd", "x", "y")], DOCS)
    got = sorted((r.doc_id or 0, r.n_removed) for r in linededup.deduplicate_lines(docs).collect())
    assert got == [(0, 0), (1, 1), (1, 2)]
    assert linededup.deduplicate_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("few", [linededup.FEW, 1])
def test_small_tiles_are_compared_at_once(monkeypatch, few):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(linededup, "FEW", few)
    monkeypatch.setattr(linededup, "FEW_TOKENS", 700)
    if few > 1:
        monkeypatch.setattr(linededup, "_overlaps", None)  # compares one tile at a time
    random.seed(3)
    rows, want = [], []
    for tile in range(200):
        base, held = random.sample(range(10**9), 20), []
        for k in range(random.choice([1, 2, 2, 3, 5, 9])):
            tokens = set(base[:random.randrange(14, 21)]) | set(random.sample(range(10**9), random.randrange(3)))
            held.append((tile * 100 + k, random.choice([None, 1, 2]) or -1, random.randrange(10**6), k, tokens))
        for key, *rank, tokens in held:
            if any(r < rank and len(tokens & t) * 5 >= len(tokens | t) * 4 for _, *r, t in held):
                want.append(key)
        rows += [{"gid": tile // 2, "down": 0, "across": tile % 2, "key": key, "doc": doc, "row": row, "line": line,
                  "tokens": np.array(sorted(t), np.uint64).tobytes()} for key, doc, row, line, t in held]
    table = pa.Table.from_pylist(rows)
    got = [k for b in linededup._matches(iter(table.to_batches(max_chunksize=90))) for k in b.column(0).to_pylist()]
    assert sorted(got) == sorted(want) and 100 < len(want) < len(rows) - 200


def test_words_of_any_length_are_told_apart():
    import pyarrow as pa

    words = [c * n for c in ("a", "b", "é", "\0") for n in range(1, 70)] + ["a" * n + "b" for n in range(1, 140)] + ["x" * 5000]
    text = pa.array([" ".join(words), "q\t" + "\n".join(reversed(words)) + " \x0b", None])
    lines = linededup.Lines(text)
    assert len(set(lines.word.tolist())) == len(set(words)) + 1
    assert lines.word.tolist()[len(words) + 1:] == lines.word.tolist()[:len(words)][::-1]
    assert lines.words.tolist() == [len(words), 2] + [1] * (len(words) - 1) + [0]
