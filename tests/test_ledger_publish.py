"""Ledger (S5, S6, S14, R5), publish (P3-P6, W4-W6, J7, J8, A9) on the reference's cases."""

import json

import pytest
from pyspark.sql import functions as F

from alertlake.operators import publish as PB
from alertlake.sources import ledger as LG


def L(spark, rows):
    return spark.createDataFrame(rows, LG.LEDGER_SCHEMA)


def test_low_watermark(spark):
    led = L(spark, [("a", "g1", "f", "", "2026-06-10T02:00:00Z", "", "OK"),
                    ("b", "before_gmail_api", "f", "", "2026-06-20T10:00:00Z", "", "OK")])
    r = LG.low_watermark(led).first()
    assert r["last_fetch"] == "2026-06-10T02:00:00Z"     # sentinel row ignored
    assert r["after_date"] == "2026/06/09"                # 02:00 minus 6 h -> previous day
    assert LG.low_watermark(L(spark, [])).first()["after_date"] is None


def test_json_ledger_from_path_and_uri(spark, tmpdir_path):
    p = tmpdir_path / "ledger.json"
    p.write_text(json.dumps({"<m1>": {"gmail_id": "g1", "fichier": "a/x.eml", "date_email": "d",
                                      "fetched_at": "t", "indexed_at": "", "statut_extraction": "PENDING"}}))
    led = LG.read_ledger_json(spark, str(p))
    assert led.collect()[0]["fichier"] == "a/x.eml"
    assert LG.read_ledger_json(spark, f"file://{p}").collect() == led.collect()
    assert LG.read_ledger_json(spark, str(tmpdir_path / "none.json")).count() == 0


def test_only_a_missing_path_reads_as_empty(spark, tmpdir_path):
    assert LG.read_table(spark, str(tmpdir_path / "none"), "a string").count() == 0
    with pytest.raises(Exception):
        LG.read_table(spark, str(tmpdir_path), "a string", "no-such-format")


def test_upsert_index_defaults(spark):
    old = L(spark, [("<a>", "g1", "p/a.eml", "d0", "2026-01-01T00:00:00Z", "", "OK"),
                    ("<b>", "manual", "p/b.eml", "d0", "t0", "", "PENDING")])
    idx = spark.createDataFrame([("<a>", "p/20260101-0100-a.eml", "d1"), ("<c>", "p/c.eml", "d2")],
                                "message_id string, fichier string, date_email string")
    out = {r["message_id"]: r for r in LG.upsert_index(old, idx, F.lit("NOW")).collect()}
    assert out["<a>"]["gmail_id"] == "g1" and out["<a>"]["statut_extraction"] == "OK"
    assert out["<a>"]["fichier"] == "p/20260101-0100-a.eml" and out["<a>"]["indexed_at"] == "NOW"
    assert out["<c>"]["gmail_id"] == "manual" and out["<c>"]["fetched_at"] == "NOW"
    assert out["<c>"]["statut_extraction"] == "PENDING"
    assert out["<b>"]["fichier"] == "p/b.eml" and out["<b>"]["indexed_at"] == ""


def test_legacy_index(spark):
    idx = spark.createDataFrame([(1, "<m>", "a.eml", "d", "i1", ""), (2, "<m>", "b.eml", "d", "i2", "OK"),
                                 (3, "<n>", "c.eml", "d", "i3", None)],
                                "o int, `Message-ID` string, Fichier string, Date_email string, "
                                "Date_indexation string, Statut_extraction string")
    out = {r["message_id"]: r for r in LG.legacy_index_to_ledger(idx, "o").collect()}
    assert out["<m>"]["fichier"] == "b.eml" and out["<m>"]["statut_extraction"] == "OK"
    assert out["<n>"]["statut_extraction"] == "PENDING" and out["<n>"]["gmail_id"] == "before_gmail_api"


def test_publish_delta_and_max(spark):
    rows = spark.createDataFrame([("E000005", 1), ("E000002", 2), ("E000003", 3)], "ID string, o int")
    assert sorted(r["ID"] for r in PB.publish_delta(rows, 1).collect()) == ["E000002", "E000003", "E000005"]
    pub = spark.createDataFrame([("E000001",), ("E000003",), ("E000002",)], "ID string")
    assert pub.agg(PB.max_published(pub)).first()[0] == 3
    assert pub.limit(0).agg(PB.max_published(pub)).first()[0] == 0
    # replay: after publishing, the same delta is empty
    assert PB.publish_delta(rows, 5).count() == 0


def test_islands(spark):
    reasons = ["", "x", "", "", "y"]
    df = spark.createDataFrame([(100 + i, r) for i, r in enumerate(reasons)], "pos long, r string")
    out = PB.islands(df, "pos", F.when(F.col("r") == "", F.lit("dropdown")).otherwise(F.lit("clear")))
    got = sorted((r["flag"], r["range_start"], r["range_end"]) for r in out.collect())
    assert got == [("clear", 101, 101), ("clear", 104, 104), ("dropdown", 100, 100), ("dropdown", 102, 103)]


def test_gate(spark):
    audit = spark.createDataFrame([("failed", "t1", None), ("ok", "t2", None)], "status string, recorded_at string, acked_at string")
    assert PB.gate_state(audit).first()["blocked"] is True
    acked = spark.createDataFrame([("failed", "t1", "t9")], "status string, recorded_at string, acked_at string")
    assert PB.gate_state(acked).first()["blocked"] is False


def test_resolve_ids_cap_and_cleanup(spark):
    led = L(spark, [("<a>", "g1", "", "", "", "", "OK"), ("<b>", "manual", "", "", "", "", "OK"),
                    ("<c>", "g3", "", "", "", "", "ERREUR"), ("<d>", "g4", "", "", "", "", "PENDING")])
    ids = spark.createDataFrame([("<a>", 1), ("<b>", 2), ("<z>", 3)], "message_id string, pos int")
    assert [r["gmail_id"] for r in PB.resolve_source_ids(ids, led).orderBy("pos").collect()] == ["g1"]
    assert sorted(r[0] for r in PB.processed_source_ids(led).collect()) == ["g1"]
    with pytest.raises(RuntimeError):
        PB.check_cap(spark.range(201))
    PB.check_cap(spark.range(200))


def test_after_date_fallback_and_error(spark):
    only_sentinels = L(spark, [("a", "manual", "f", "", "2026-06-10T02:00:00Z", "", "OK")])
    assert LG.after_date(only_sentinels, since_days=3, now="2026-06-10T12:00:00Z") == "2026/06/07"
    with pytest.raises(ValueError):
        LG.after_date(only_sentinels)
    real = L(spark, [("a", "g1", "f", "", "2026-06-10T02:00:00Z", "", "OK")])
    assert LG.after_date(real, since_days=3) == "2026/06/09"


def test_ledger_commits_write_only_the_rows_they_change(spark, tmpdir_path):
    ledger = LG.ledger_table(spark, str(tmpdir_path / "bl"))
    ledger.commit("init", lambda _: L(spark, [(f"<m{i}>", "g", f"p/{i}.eml", "", "", "", "PENDING") for i in range(40)]))
    before = ledger.state().parts
    LG.record_statuses(ledger, "update", spark.createDataFrame([("<m3>", "OK"), ("<none>", "OK")], "message_id string, statut_extraction string"))
    cur = {r["message_id"]: r["statut_extraction"] for r in LG.read_ledger(spark, ledger.root).collect()}
    assert len(cur) == 40 and cur["<m3>"] == "OK" and cur["<m4>"] == "PENDING"
    assert [p.rows for p in ledger.state().parts if p not in before] == [1]
    one = LG.read_ledger(spark, ledger.root, spark.createDataFrame([("<m3>",)], "message_id string"))
    assert 0 < one.count() < 40 and one.where("message_id = '<m3>'").first()["statut_extraction"] == "OK"
