"""Many terms in one pass, against a search for each term by itself."""

import random
import re

from pyspark.sql import functions as F

from alertlake.functions import terms as TM
from alertlake.functions import text as T


def _plain(text, terms, whole):
    edge = ("(?<![a-zA-Z0-9])", "(?![a-zA-Z0-9])") if whole else ("", "")
    return sorted({i for t, numbers in terms.items() if re.search(edge[0] + re.escape(t) + edge[1], text) for i in numbers})


def test_numbers_are_those_of_each_term_alone(spark):
    rng = random.Random(2)
    letters = "ab c.+-é'(|😀"
    for whole in (False, True):
        for size in (1, 5, 60):
            terms: dict = {}
            for i in range(size):
                terms.setdefault("".join(rng.choices(letters, k=rng.randint(1, 5))), []).append(i)
            texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(150)]
            df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
            got = {r.i: r.n for r in df.select("i", TM.numbers_in(F.col("t"), terms, whole).alias("n")).collect()}
            assert got == {i: _plain(t, terms, whole) for i, t in enumerate(texts)}


def test_empty_terms_null_texts_and_no_terms(spark):
    one = spark.range(1)
    null = F.lit(None).cast("string")
    assert one.select(T.blacklist_term(null), T.stack_tags(null)).first()[:] == (None, "")
    assert one.select(T.blacklist_term(F.lit("x"), []), T.stack_tags(F.lit("x"), {})).first()[:] == (None, "")
    assert one.select(T.blacklist_term(F.lit("a b"), ["z", "", "a"])).first()[0] == ""
    assert one.select(T.blacklist_term(F.lit("chef de projet"), ["chef de projet", "chef"])).first()[0] == "chef de projet"
    assert one.select(T.blacklist_term(F.lit("chef de projet"), ["projet", "chef de projet"])).first()[0] == "projet"


def test_thousands_of_terms(spark):
    kw = {f"tag{i}": [f"term {i}", f"t{i}.x"] for i in range(4000)}
    got = spark.range(1).select(T.stack_tags(F.lit("TERM 12, t399.x et term 39999 (t3999.x)"), kw)).first()[0]
    assert got == "tag12,tag399,tag3999"
