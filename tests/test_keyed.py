"""Keyed tables: commits, writers at the same time, merging, splitting, the key index and ID reservations."""

import threading

import pytest
from pyspark.sql import functions as F

from alertlake.sources import archive as A, files, keyed, ledger as LG
from alertlake.sources.keyed import KeyedTable

SCHEMA = "k string, v bigint"


def _t(spark, path, **kw):
    return KeyedTable(spark, str(path), SCHEMA, "k", **kw)


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def _dict(df):
    return {r.k: r.v for r in df.collect()}


def test_commits_upsert_once_and_read_by_bucket(spark, tmpdir_path):
    t = _t(spark, tmpdir_path / "t")
    assert t.read().collect() == [] and t.state().version == 0
    t.commit("one", lambda _: _rows(spark, ("a", 1), ("b", 2), (None, 9)))
    t.commit("two", lambda _: _rows(spark, ("b", 3), ("c", 4)))
    t.commit("two", lambda _: _rows(spark, ("b", 99)))               # committed already
    assert _dict(t.read()) == {"a": 1, "b": 3, "c": 4, None: 9}
    assert _dict(t.read(_rows(spark, ("b", 0))))["b"] == 3
    paths = t.read(_rows(spark, ("b", 0))).inputFiles()
    assert paths and all(p.split("_bucket=")[1].split("/")[0] == str(t.buckets_of(_rows(spark, ("b", 0)), t.state().bits).pop())
                         for p in paths)
    assert t.committed("two") and not t.committed("two", after=2) and not t.committed("three")
    t.commit("none", lambda now: now.where("false"))
    assert len(t.read().collect()) == 4


def test_an_update_is_computed_again_after_a_conflict(spark, tmpdir_path):
    """Another writer commits between our read and our commit: nothing of either is lost."""
    t, other = _t(spark, tmpdir_path / "t"), _t(spark, tmpdir_path / "t")
    t.commit("start", lambda _: _rows(spark, ("a", 1), ("b", 1)))
    seen = []

    def add(now):
        if not seen:
            other.commit("other", lambda rows: rows.where("k = 'a'").withColumn("v", F.col("v") + 10), _rows(spark, ("a", 0)))
        seen.append(1)
        return now.where("k = 'a'").withColumn("v", F.col("v") + 100)

    t.commit("mine", add, _rows(spark, ("a", 0)))
    assert len(seen) == 2 and _dict(t.read()) == {"a": 111, "b": 1}


def test_writers_at_the_same_time_lose_nothing(spark, tmpdir_path):
    root, errors = str(tmpdir_path / "l"), []
    LG.ledger_table(spark, root).commit("init", lambda _: spark.createDataFrame(
        [(f"<{i}>", "g", f"{i}.eml", "", "", "", "PENDING") for i in range(20)], LG.LEDGER_SCHEMA))

    def work(n):
        try:
            ledger = LG.ledger_table(spark, root)
            status = spark.createDataFrame([(f"<{i}>", f"S{n}") for i in range(n, 20, 4)], "message_id string, statut_extraction string")
            LG.record_statuses(ledger, f"status {n}", status)
            LG.index_messages(ledger, f"index {n}", spark.createDataFrame(
                [(f"<new{n}>", "n.eml", "d", None)], "message_id string, fichier string, date_email string, gmail_id string"), F.lit("t"))
        except Exception as e:  # shown by the assertion below
            errors.append(e)

    threads = [threading.Thread(target=work, args=(n,)) for n in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    got = {r.message_id: r.statut_extraction for r in LG.read_ledger(spark, root).collect()}
    assert got == {**{f"<{i}>": f"S{i % 4}" for i in range(20)}, **{f"<new{n}>": "PENDING" for n in range(4)}}


def test_create_once_has_one_winner(spark, tmpdir_path):
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append(files.create_once(spark, str(tmpdir_path / "f"), str(i)))) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert won.count(True) == 1 and files.names(spark, str(tmpdir_path)) == ["f"]
    assert files.create_once(spark, str(tmpdir_path / "é"), "ü") and files.read_text(spark, str(tmpdir_path / "é")) == "ü"
    files.delete(spark, str(tmpdir_path / "none"))


def test_buckets_merge_split_and_sum_up(spark, tmpdir_path, monkeypatch):
    """Many commits: deltas are merged, the table uses more bits as it grows, the log is summed up; reads agree."""
    monkeypatch.setattr(keyed, "MAX_DELTAS", 2)
    monkeypatch.setattr(keyed, "SUMMARY_EVERY", 4)
    t = _t(spark, tmpdir_path / "t", split_rows=2)
    monkeypatch.setattr(KeyedTable.merge_buckets, "__defaults__", (2,))
    want = {}
    for n in range(7):
        rows = [(f"k{i}", n * 100 + i) for i in range(n * 6, n * 6 + 12)]
        want.update(rows)
        t.commit(f"c{n}", lambda _, rows=rows: _rows(spark, *rows))
        assert _dict(t.read()) == want
    state = t.state()
    assert any(p.base for p in state.parts) and state.bits > keyed.FIRST_BITS
    assert any(n.endswith(".sum.json") for n in files.names(spark, f"{t.root}/log"))
    for i in (0, 20, 47):
        assert _dict(t.read(_rows(spark, (f"k{i}", 0)))).get(f"k{i}") == want[f"k{i}"]
    t.merge_buckets(0)
    assert all(p.base for p in t.state().parts if p.bits == t.state().bits)
    assert _dict(t.read()) == want
    assert t.vacuum() > 0 and _dict(t.read()) == want


def test_a_small_upsert_rewrites_a_small_part(spark, tmpdir_path):
    t = _t(spark, tmpdir_path / "t")
    t.commit("big", lambda _: spark.range(200_000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")))
    before = t.state()
    t.commit("small", lambda _: spark.range(1000).select(F.concat(F.lit("k"), F.col("id") * 3).alias("k"), F.lit(-1).cast("long").alias("v")))
    new = [p for p in t.state().parts if p not in before.parts]
    assert sum(p.rows for p in new) == 1000 and set(before.parts) <= set(t.state().parts)
    assert t.read().where("v = -1").count() == 1000 and t.read().count() == 200_000


def test_key_index_adds_up_in_any_order(spark, tmpdir_path):
    offers = "Cle_dedup string, ID string"
    runs = {"r1": [("x", "E000001"), ("y", "E000002"), ("", "E000003"), (None, "E000004")], "r2": [("x", "E000010"), ("z", "E000011")]}
    got = []
    for order in (["r1", "r2"], ["r2", "r1", "r1"]):
        a = A.Archive(spark, str(tmpdir_path / "-".join(order)))
        for run in order:
            a.add_keys(run, spark.createDataFrame(runs[run], offers))
        got.append(sorted(map(tuple, a.keys.read().collect())))
        asked = spark.createDataFrame([("x",), ("z",), ("new",)], "Cle_dedup string")
        assert sorted(map(tuple, a.known(asked, "last").collect())) == [("x", "E000010"), ("z", "E000011")]
        assert sorted(map(tuple, a.known(asked, "first").collect())) == [("x", "E000001"), ("z", "E000011")]
    assert got[0] == got[1] == [("x", "E000001", 1, "E000010", 10, 2), ("y", "E000002", 2, "E000002", 2, 1),
                                ("z", "E000011", 11, "E000011", 11, 1)]


def test_ids_are_reserved_and_partitions_claimed_once(spark, tmpdir_path):
    a = A.Archive(spark, str(tmpdir_path / "a"))
    assert a.reserve("r1", 3) == 1 and a.reserve("r2", 0) == 4 and a.reserve("r3", 2) == 4
    assert a.reserve("r1", 3) == 1                      # the same run again
    parts, before = a.claim("b1", hidden=["r3"])
    assert [(p["run"], p["rows"]) for p in parts] == [("r1", 3)] and before == 0
    assert [p["run"] for p in a.claim("b1", [])[0]] == ["r1"]         # a batch claims once
    parts, before = a.claim("b2", [])
    assert [p["run"] for p in parts] == ["r3"] and before == 3
    a.release("b2")
    assert a.unpublished([]) == 2
    parts, before = a.claim("b3", [])
    assert [p["run"] for p in parts] == ["r3"] and before == 3
    assert a.claim("b2", [])[0] == [] and a.unpublished([]) == 0


def test_conflicts_end(spark, tmpdir_path):
    t = _t(spark, tmpdir_path / "t")
    n = [0]

    def never(now):
        n[0] += 1
        _t(spark, tmpdir_path / "t").commit(f"o{n[0]}", lambda _: _rows(spark, ("a", n[0])))
        return _rows(spark, ("a", -1))

    with pytest.raises(keyed.Conflict):
        t.commit("mine", never, _rows(spark, ("a", 0)), attempts=2)
