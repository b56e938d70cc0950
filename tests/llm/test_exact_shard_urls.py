"""Exact dedup, sharding and URL filter against brute force and SQL."""

import random

import duckdb
import pytest

from alertlake.llm import exact, shard, urls

DOCS = "doc_id long, text string, digest string, row string"


def _docs(spark):
    random.seed(5)
    texts = [f"text {random.randrange(60)}" for _ in range(300)] + ["", None, "", "x" * 50_000, "same"] + ["same"] * 200
    return [(i, t, "clash", "clash") for i, t in enumerate(texts)]


@pytest.mark.parametrize("filter_bytes", [exact.FILTER_BYTES, 512])
def test_exact_equals_brute_force(spark, filter_bytes):
    rows = _docs(spark)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = sorted(tuple(r) for r in exact.exact_duplicates(docs, filter_bytes=filter_bytes).collect())
    assert got == sorted(exact.brute_force([r[:2] for r in rows]))
    kept = exact.drop_exact_duplicates(docs, filter_bytes=filter_bytes)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in got if r[3]]


def test_exact_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a", None, None)] * 3 + [(None, "a", None, None), (None, "b", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    out = exact.exact_duplicates(docs).collect()
    assert sorted(r.group_size for r in out) == [1, 4, 4, 4, 4]
    assert sum(r.kept for r in out if r.keep_id == 1) == 1
    assert [r.kept for r in out if r.keep_id is None] == [True]
    assert exact.drop_exact_duplicates(docs).count() == 2
    none = spark.createDataFrame([], DOCS)
    assert exact.exact_duplicates(none).count() == 0
    assert exact.drop_exact_duplicates(none).count() == 0


@pytest.mark.parametrize("limit", [200, 5_000, 10_000_000])
def test_shards_equal_sql(spark, limit):
    random.seed(1)
    rows = [(i, "é" * random.randrange(200)) for i in range(400)] + [(1000, None), (1001, "y" * 20_000)]
    got = shard.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), limit=limit).collect()
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    want = con.execute(f"select doc_id, n_bytes, shard, shard_bytes, shard_rows from ({shard.oracle(limit)})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    assert all(r.shard_bytes <= limit or r.shard_rows == 1 for r in got)


def test_shards_split_rows_of_one_id(spark):
    rows = [(7, "z" * 100, "clash")] * 300 + [(8, "b", "clash"), (None, "", "clash")]
    got = shard.assign_shards(spark.createDataFrame(rows, "doc_id long, text string, shard string"), limit=1_000).collect()
    assert len(got) == 302
    assert all(r.shard_bytes <= 1_000 for r in got)
    assert shard.assign_shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_shards_run_without_python(spark):
    plan = shard.assign_shards(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


URLS = ["https://www.example.com/en/a", "http://EXAMPLE.com/en/", "http://example.com/en", "http://a.net/es/x?y#z",
        "http://net/fr/1", "http://x.org/a.net/fr/", "http://xnet/fr/", "http://a.com", "http://a.com?/en/", "plain", None, "",
        "://example.com/en/q", "http://m.example.com/en/é", "http://a.net/es", "http://a.com#x://net/fr/", "http://" + "a." * 3000 + "net/fr/b",
        "http://É.com/", "http://www.example.com/fr/"]


def _by_rules(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        for stop in "?#":
            rest = rest.split(stop)[0]
        host, path = rest.split("/")[0], rest[len(rest.split("/")[0]):]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, "allow")))


def test_urls_equal_plain_rules_and_sql(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    got = sorted(tuple(r) for r in urls.judge_urls(pages).collect())
    assert [r[1:] for r in got] == [_by_rules(u) for u in URLS]
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", list(enumerate(URLS)))
    want = con.execute(f"select page_id, host, path, rule, verdict from ({urls.oracle()}) order by 1").fetchall()
    assert got == want
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_automaton_equals_regular_expressions():
    import re

    random.seed(2)
    globs = ["".join(random.choice(["a", "b", "/", "*", "**"]) for _ in range(random.randrange(1, 9))) for _ in range(60)]
    texts = ["".join(random.choice("ab/") for _ in range(random.randrange(9))) for _ in range(200)]
    got = urls.GlobAutomaton(globs).fits([t.encode() for t in texts])
    for j, g in enumerate(globs):
        parts = re.findall(r"\*\*|\*|.", g)
        expr = "".join({"**": ".*", "*": "[^/]*"}.get(p, p) for p in parts)
        assert [bool(re.fullmatch(expr, t)) for t in texts] == got[:, j].tolist(), g
