"""Randomised checks of the distributed algorithms against sequential simulations."""

import random

from pyspark.sql import functions as F

from alertlake.operators import publish as PB
from alertlake.operators import route as R


def simulate_names(existing, renames):
    """Sequential: each file in path order takes base.eml, else base_2, base_3, ..."""
    taken = set(existing)
    out = {}
    for folder, base, path in sorted(renames, key=lambda r: r[2].split("/")):
        name = f"{base}.eml"
        n = 2
        while (folder, name) in taken:
            name = f"{base}_{n}.eml"
            n += 1
        taken.add((folder, name))
        out[path] = name
    return out


def test_canonical_names_random(spark):
    rnd = random.Random(7)
    for trial in range(4):
        existing = set()
        for _ in range(rnd.randint(0, 12)):
            f, b = rnd.choice("pq"), rnd.choice(["x", "y"])
            existing.add((f, rnd.choice([f"{b}.eml", f"{b}_{rnd.randint(1, 6)}.eml", f"{b}_0{rnd.randint(2, 3)}.eml"])))
        renames = [(rnd.choice("pq"), rnd.choice(["x", "y"]), f"{rnd.choice('pq')}/f{i:02d}.eml") for i in range(rnd.randint(1, 10))]
        ren = spark.createDataFrame(renames, "folder string, base string, path string")
        ex = spark.createDataFrame(sorted(existing) or [("z", "none.eml")], "folder string, name string")
        got = {r["path"]: r["new_name"] for r in R.canonical_names(ren, ex).collect()}
        assert got == simulate_names(existing, renames), trial


def simulate_islands(flags, start):
    out, run_start = [], None
    for i, f in enumerate(flags + [None]):
        if run_start is not None and (f != flags[run_start - start] if i < len(flags) else True):
            out.append((flags[run_start - start], run_start, start + i - 1))
            run_start = None
        if i < len(flags) and run_start is None:
            run_start = start + i
    return sorted(out)


def test_islands_random(spark):
    rnd = random.Random(11)
    flags = [rnd.choice(["dropdown", "clear"]) for _ in range(300)]
    df = spark.createDataFrame([(100 + i, f) for i, f in enumerate(flags)], "pos long, f string")
    got = sorted((r["flag"], r["range_start"], r["range_end"]) for r in PB.islands(df, "pos", F.col("f")).collect())
    assert got == simulate_islands(flags, 100)
