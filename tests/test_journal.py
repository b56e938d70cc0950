"""Runs that die at any write: their replay gives the tables of an undisturbed run (P10, ST3, ST4)."""

import pytest
from pyspark.sql import functions as F

from alertlake import session
from alertlake.plans import pipeline as P
from alertlake.plans.journal import Journal
from alertlake.sources import files, keyed, ledger as LG
from alertlake.streaming import ingest as S
from tests.test_extract import li_card
from tests.test_pipeline import LI, TC, two_jobs, write_eml

NOW = "2026-06-02T10:00:00Z"
DAY = "Mon, 01 Jun 2026 10:00:00 +0200"
SENDER = "L <j@linkedin.com>"


class Killed(RuntimeError):
    pass


def _fill(src, tag=""):
    write_eml(src / f"a{tag}.eml", f"<a{tag}@x>", SENDER, "x", DAY, LI)
    write_eml(src / f"b{tag}.eml", f"<b{tag}@x>", "T <n@alerts.talent.com>", "x", DAY, TC)
    write_eml(src / f"c{tag}.eml", f"<a{tag}@x>", SENDER, "x", DAY, LI)       # a duplicate
    write_eml(src / f"d{tag}.eml", None, SENDER, "x", DAY, LI)                # no Message-ID


def _tables(spark, ws):
    """All shared tables of a workspace, without times and names of runs."""
    def rows(name, schema, stage, *cols):
        return sorted(map(str, ws.read_whole(spark, name, schema, stage).select(*cols).collect()))

    offers = [c for c in P.OFFERS_SCHEMA.replace("`", "").replace(" string", "").split(", ") if c != "run_id"]
    return {
        "offers": rows("offers", P.OFFERS_SCHEMA, "extract", *offers),
        "emails": rows("emails", P.EMAIL_COLS, "index", "message_id", "path"),
        "published": sorted(map(str, LG.read_table(spark, ws.path("published"), P.OFFERS_SCHEMA + ", sheet_row bigint")
                                .select("ID", "sheet_row").collect())),
        "quarantine": rows("quarantine", P.QUARANTINE_SCHEMA, "index", "path", "quarantine_path"),
        "errors": rows("index_errors", "path string, reason string, run_id string", "index", "path", "reason"),
        "history": rows("run_history", "Offres_extraites bigint, run_id string", "extract", "Offres_extraites"),
        "audit": sorted(map(str, P._audit_state(spark, ws).select("status").collect())),
        "ledger": sorted(map(str, LG.read_ledger(spark, ws.path("ledger")).drop("fetched_at", "indexed_at").collect())),
        "keys": sorted(map(str, ws.archive(spark).keys.read().collect())),
        "parts": sorted(map(str, ws.archive(spark).parts.read().drop("part", "run", "published_by").collect())),
    }


def _writes(monkeypatch, stop_at):
    """Count the durable steps of a run, and die before step ``stop_at`` (None: never)."""
    count = [0]

    def step(real):
        def run(*a, **k):
            count[0] += 1
            if count[0] == stop_at:
                raise Killed(stop_at)
            return real(*a, **k)
        return run

    monkeypatch.setattr(P, "_replace_run", step(P._replace_run))
    monkeypatch.setattr(P, "_audit", step(P._audit))
    monkeypatch.setattr(files, "create_once", step(files.create_once))
    monkeypatch.setattr(keyed.KeyedTable, "_write", step(keyed.KeyedTable._write))
    return count


@pytest.fixture(scope="module")
def undisturbed(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("plain")
    _fill(home / "src")
    ws = P.Workspace(str(home / "ws"), str(home / "src"))
    with pytest.MonkeyPatch.context() as m:
        count = _writes(m, None)
        P.run_pipeline(spark, ws, "r1", NOW, cfg=two_jobs())
    return _tables(spark, ws), count[0]


#: One step in every stretch of the run: index, its effects, snapshot, reservation, extraction, its effects,
#: claim, publish, mark, end.
STEPS = [4, 13, 21, 28]


@pytest.mark.parametrize("stop_at", STEPS)
def test_batch_replay_after_a_stop_at_any_write(spark, tmpdir_path, monkeypatch, undisturbed, stop_at):
    want, steps = undisturbed
    if stop_at > steps:
        pytest.skip("the run has fewer steps")
    _fill(tmpdir_path / "src")
    ws = P.Workspace(str(tmpdir_path / "ws"), str(tmpdir_path / "src"))
    with monkeypatch.context() as m:
        _writes(m, stop_at)
        with pytest.raises(Killed):
            P.run_pipeline(spark, ws, "r1", NOW, cfg=two_jobs())
    assert not session._KEPT
    if not P._audit_state(spark, ws).where("status = 'failed'").isEmpty():  # it died while publishing
        P.ack_failures(spark, ws, NOW)
    P.run_pipeline(spark, ws, "r1", "2026-06-09T10:00:00Z", cfg=two_jobs())
    got = _tables(spark, ws)
    got["audit"] = [a for a in got["audit"] if "failed" not in a]
    # giving back a failed claim is remembered in the published part's row
    strip = [str(p).replace("above=1", "above=None") if "kind='published'" in p else p for p in got["parts"]]
    assert {**got, "parts": strip} == want
    assert not Journal(spark, ws.path("journal")).unfinished("done")
    # done is done: the report again, and no change
    P.run_pipeline(spark, ws, "r1", NOW, cfg=two_jobs())
    assert _tables(spark, ws)["offers"] == want["offers"]


def test_another_run_does_not_see_a_dead_one(spark, tmpdir_path, monkeypatch):
    """Offers of a run without its record are not in the archive: they are neither linked to nor published."""
    src = tmpdir_path / "src"
    write_eml(src / "a.eml", "<a@x>", SENDER, "x", DAY, LI)
    ws = P.Workspace(str(tmpdir_path / "ws"), str(src))
    with monkeypatch.context() as m:
        real = P.enrich.rejects
        m.setattr(P.enrich, "rejects", lambda raw: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            P.run_pipeline(spark, ws, "r1", NOW, cfg=two_jobs())
        assert real
    assert ws.read(spark, "offers", P.OFFERS_SCHEMA).count() == 1
    assert ws.read_whole(spark, "offers", P.OFFERS_SCHEMA, "extract").count() == 0
    r2 = P.run_pipeline(spark, ws, "r2", NOW, cfg=two_jobs())
    assert r2["published"] == 1 and r2["extract"]["doublons"] == 0
    whole = ws.read_whole(spark, "offers", P.OFFERS_SCHEMA, "extract").collect()
    assert [(r["ID"], r["run_id"]) for r in whole] == [("E000002", "r2")]  # E000001 stays the dead run's


@pytest.mark.parametrize("stop_at", [7, 22])
def test_stream_replay_after_a_stop(spark, tmpdir_path, monkeypatch, undisturbed, stop_at):
    src = tmpdir_path / "src"
    _fill(src)
    ws = P.Workspace(str(tmpdir_path / "ws"), str(src))

    def go():
        S.start(spark, ws, str(tmpdir_path / "ck"), cfg=two_jobs(), now=NOW, query_id="q").awaitTermination(300)

    with monkeypatch.context() as m:
        _writes(m, stop_at)
        with pytest.raises(Exception):
            go()
    if not P._audit_state(spark, ws).where("status = 'failed'").isEmpty():
        P.ack_failures(spark, ws, NOW)
    write_eml(src / "z.eml", "<z@x>", SENDER, "x", DAY, li_card(77, "Relieur"))
    go()
    got = _tables(spark, ws)
    assert len(got["offers"]) == 3 and len(got["published"]) == 3
    # the stream drops a repeated Message-ID before it is landed, whichever file comes first
    landed = [r.message_id for r in ws.read_whole(spark, "emails", P.EMAIL_COLS, "index").collect()]
    assert sorted(landed) == ["<a@x>", "<b@x>", "<z@x>"]


def test_journal_records_once(spark, tmpdir_path):
    j = Journal(spark, str(tmpdir_path / "j"))
    assert j.begin("run/1", {"now": "t0"}) == {"now": "t0"} == j.begin("run/1", {"now": "t1"})
    done = []
    for _ in range(3):
        assert j.stage("run/1", "s", lambda: done.append("computed") or {"n": len(done)}, lambda: done.append("applied")) == {"n": 1}
    assert done == ["computed", "applied"] and j.unfinished("s") == [] and j.unfinished("t") == ["run/1"]
    j.close("run/1", {})
    assert j.unfinished("t") == []


def test_files_are_found_by_time_and_name(spark, tmpdir_path):
    """Only files within the new ones' times are opened; names with odd characters are read as they stand."""
    import os

    src = tmpdir_path / "src"
    ws = P.Workspace(str(tmpdir_path / "ws"), str(src))
    for i, name in enumerate(["old.eml", "x [1]{a}*.eml", "é%20 ü.eml"]):
        write_eml(src / name, f"<{i}@x>", SENDER, "x", DAY, LI)
    os.utime(src / "old.eml", (1_600_000_000, 1_600_000_000))
    LG.index_messages(ws.ledger(spark), "t", spark.createDataFrame([("<0@x>", "old.eml", "d", None)], P.INDEXED_SCHEMA), F.lit(NOW))
    found = P.new_files(spark, ws, "r1", False)
    assert sorted(r.path for r in found.collect()) == sorted(["x [1]{a}*.eml", "é%20 ü.eml"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" not in plan or "modificationTime" in plan
    assert P.new_files(spark, P.Workspace(str(tmpdir_path / "ws2"), str(tmpdir_path / "src" / "..")), "r", True).count() == 3
