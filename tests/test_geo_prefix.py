"""The first dimension entry that starts with a word, by equality of beginnings."""

import random

from alertlake.operators import geo


def test_first_with_prefix_equals_a_scan(spark):
    rng = random.Random(3)
    keys = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(200)] + ["", "aa", "aa"]
    dim = [(i, k, f"{i:02d}"[-2:]) for i, k in enumerate(keys)]
    words = sorted({k[:rng.randint(1, 4)] for k in keys if k} | {"zz", "a" * 50, "é"})
    got = geo.first_with_prefix(spark.createDataFrame([(w,) for w in words], "w string"), "w",
                                spark.createDataFrame(dim, "pos int, city_key string, dept string"), "city_key")
    want = {w: next((d for _, k, d in dim if k.startswith(w)), None) for w in words}
    assert {r.w: r.dept for r in got.collect()} == {w: d for w, d in want.items() if d is not None}
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_no_words_and_no_dimension(spark):
    dim = spark.createDataFrame([(0, "nice", "06")], "pos int, city_key string, dept string")
    words = spark.createDataFrame([("n",)], "w string")
    assert geo.first_with_prefix(words.where("false"), "w", dim, "city_key").collect() == []
    assert geo.first_with_prefix(words, "w", dim.where("false"), "city_key").collect() == []
