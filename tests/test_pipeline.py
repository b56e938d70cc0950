"""End-to-end batch runs over real .eml files (P10, S1-S3, ST-free)."""

from email.message import EmailMessage

import pytest
from pyspark.sql import functions as F

from alertlake.plans import pipeline as P
from alertlake.sources import ledger as LG
from tests.test_extract import ft_card, li_card, tc_card

FT = ft_card("900ZZZZ", "Régleur", "13 - Marseille", "Usine Sud", "CDD")
LI = li_card(9876543210, "Ingénieure Qualité", "Aéro Sud · Marignane (Hybride)", "Freelance")
TC = tc_card("Cariste - CDD", "0a1b2c", "Toulon, Var, France", "Quai Sud")


def write_eml(path, mid, sender, subject, date, html):
    msg = EmailMessage()
    msg["From"] = sender
    msg["Subject"] = subject
    if mid:
        msg["Message-ID"] = mid
    msg["Date"] = date
    msg.set_content("texte brut")
    msg.add_alternative(html, subtype="html")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(bytes(msg))


@pytest.fixture()
def workspace(tmpdir_path):
    src = tmpdir_path / "sources"
    write_eml(src / "linkedin" / "a.eml", "<a@x>", "LinkedIn <jobalerts-noreply@linkedin.com>", "Offres",
              "Mon, 01 Jun 2026 10:00:00 +0200", LI)
    write_eml(src / "talent-com" / "b.eml", "<b@x>", "Talent <no-reply@alerts.talent.com>", "Alerte",
              "Mon, 01 Jun 2026 09:00:00 +0000", TC)
    write_eml(src / "france-travail" / "c.eml", "<c@x>", "FT <nepasrepondre@offre.francetravail.fr>",
              "Nouvelles offres", "Tue, 02 Jun 2026 08:00:00 +0200", FT)
    write_eml(src / "meteojob" / "d.eml", "<d@x>", "MJ <ne-pas-repondre@meteojob.com>", "Digest",
              "Tue, 02 Jun 2026 08:00:00 +0200", "<p>Rien</p>")
    write_eml(src / "misc" / "e.eml", "<e@x>", "X <a@unknown.example>", "?", "Tue, 02 Jun 2026 08:00:00 +0200", "<p/>")
    write_eml(src / "misc" / "f.eml", "<a@x>", "LinkedIn <jobalerts-noreply@linkedin.com>", "Offres",
              "Mon, 01 Jun 2026 10:00:00 +0200", LI)                          # same Message-ID as a.eml
    write_eml(src / "hellowork" / "g.eml", "<g@x>", "HW <x@hellowork.com>", "?", "Tue, 02 Jun 2026 08:00:00 +0200", "<p/>")
    write_eml(src / "tests" / "t.eml", "<t@x>", "LinkedIn <j@linkedin.com>", "x", "Tue, 02 Jun 2026 08:00:00 +0200", LI)
    return P.Workspace(str(tmpdir_path / "ws"), str(src))


def test_two_runs(spark, workspace):
    r1 = P.run_pipeline(spark, workspace, "r1", "2026-06-02T10:00:00Z")
    assert r1["index"]["duplicate"] == 1
    ex = r1["extract"]
    assert ex["offres_ecrites"] == 3 and ex["fichiers_ok"] == 3
    assert ex["erreurs"] == 1 and ex["ignores"] == 1     # unknown domain; provider without a job
    assert ex["fichiers_partiel"] == 1                   # Q2: the digest is shadowed, extracted, 0 offers
    led = {r["message_id"]: r for r in LG.read_ledger(spark, workspace.path("ledger")).collect()}
    assert led["<a@x>"]["fichier"] == "linkedin/a.eml"          # first path in sort order
    assert led["<a@x>"]["date_email"] == "2026-06-01T10:00:00+0200"
    assert {k: v["statut_extraction"] for k, v in led.items()} == {
        "<a@x>": "OK", "<b@x>": "OK", "<c@x>": "OK", "<d@x>": "PARTIEL", "<e@x>": "ERREUR", "<g@x>": "IGNORE"}
    offers = spark.read.parquet(workspace.path("offers"))
    ids = sorted(r["ID"] for r in offers.collect())
    assert ids == ["E000001", "E000002", "E000003"]
    first = offers.where(F.col("ID") == "E000001").first()   # earliest date_email string first
    assert first["Message_ID"] == "<a@x>" and first["Date_decouverte"] == "2026-06-01"
    assert offers.where(F.col("Message_ID") == "<c@x>").first()["Dept"] == "13"
    assert r1["published"] == 3
    pub = spark.read.parquet(workspace.path("published"))
    assert sorted(r["sheet_row"] for r in pub.collect()) == [2, 3, 4]       # after the header row
    assert spark.read.parquet(workspace.path("quarantine")).first()["path"] == "misc/f.eml"
    assert r1["marked"] == 0                                     # locally indexed mails carry the "manual" id

    r2 = P.run_pipeline(spark, workspace, "r2", "2026-06-03T10:00:00Z")
    assert r2["index"] == {"errors": 0}        # nothing is read again, the duplicate neither
    assert r2["index"].get("rename", 0) == 0 and r2["extract"]["offres_ecrites"] == 0
    assert r2["published"] == 0
    assert spark.read.parquet(workspace.path("published")).count() == 3


def test_gate_blocks_until_acknowledged(spark, workspace):
    P._audit(spark, workspace, "b0", "failed", "boom", "2026-06-01T00:00:00Z")
    with pytest.raises(P.PublishBlocked):
        P.run_pipeline(spark, workspace, "r1", "2026-06-02T10:00:00Z")
    P.ack_failures(spark, workspace, "2026-06-02T11:00:00Z")
    P.check_gate(spark, workspace)


def test_dry_run_writes_nothing(spark, workspace):
    import os
    r = P.run_pipeline(spark, workspace, "r1", "2026-06-02T10:00:00Z", dry_run=True)
    assert r["index"]["rename"] >= 1
    assert r["extract"]["offres_ecrites"] == 3 and r["extract"]["fichiers_ok"] == 3 and r["published"] == 3
    assert not os.path.exists(workspace.root)
    assert P.run_pipeline(spark, workspace, "r1", "2026-06-02T10:00:00Z")["published"] == 3


def test_failed_publish_is_recorded_and_blocks(spark, tmpdir_path):
    from alertlake import fixed
    ws = P.Workspace(str(tmpdir_path / "ws"), str(tmpdir_path / "none"))
    row = {c: "" for c in fixed.OFFER_COLUMNS}
    row.update({"ID": "not-an-id", "Titre": "x"})
    bad = spark.createDataFrame([tuple(row[c] for c in fixed.OFFER_COLUMNS) + ("r0",)], P.OFFERS_SCHEMA)
    bad.write.partitionBy("run_id").parquet(ws.path("offers"))
    with pytest.raises(Exception):
        P.publish_run(spark, ws, "b1", "2026-06-02T10:00:00Z", dry_run=False)
    audit = spark.read.parquet(ws.path("publish_audit")).collect()
    assert [(r["batch_id"], r["status"]) for r in audit] == [("b1", "failed")]
    with pytest.raises(P.PublishBlocked):
        P.check_gate(spark, ws)
    P.ack_failures(spark, ws, "2026-06-02T11:00:00Z")
    P.check_gate(spark, ws)


def test_csv_delta_export(spark, workspace, tmpdir_path):
    from alertlake.sources import offers_io as IO
    cfg = P.Config(csv_deltas=str(tmpdir_path / "deltas"))
    P.run_pipeline(spark, workspace, "r1", "2026-06-02T10:00:00Z", cfg=cfg)
    rows = IO.read_dated_delta(spark, cfg.csv_deltas, "20260602").collect()
    assert sorted(r["ID"] for r in rows) == ["E000001", "E000002", "E000003"]
    assert all(r["Traite"] == "FALSE" for r in rows)


def two_jobs(**fields):
    """A configuration with the jobs that these tests need; fewer jobs, shorter plans."""
    return P.Config(extractable=["linkedin", "talent_com"], **fields)


def test_unusable_mails_are_reported_once_and_get_no_id(spark, tmpdir_path):
    src = tmpdir_path / "sources"
    write_eml(src / "linkedin" / "a.eml", "<a@x>", "L <j@linkedin.com>", "x", "not a date", LI)
    write_eml(src / "linkedin" / "b.eml", None, "L <j@linkedin.com>", "x", "Mon, 01 Jun 2026 10:00:00 +0200", LI)
    write_eml(src / "linkedin" / "c[1].eml", "<c@x>", "L <j@linkedin.com>", "x", "Mon, 01 Jun 26 10:00:00 GMT", LI)
    ws = P.Workspace(str(tmpdir_path / "ws"), str(src))
    r1 = P.run_pipeline(spark, ws, "r1", "2026-06-02T10:00:00Z", cfg=two_jobs())
    assert r1["index"]["errors"] == 2 and r1["extract"]["offres_ecrites"] == 1
    assert {r.path: r.reason for r in spark.read.parquet(ws.path("index_errors")).collect()} == {
        "linkedin/a.eml": "no readable date: ", "linkedin/b.eml": "no Message-ID"}
    assert spark.read.parquet(ws.path("offers")).first()["Date_decouverte"] == "2026-06-01"
    assert P.run_pipeline(spark, ws, "r2", "2026-06-03T10:00:00Z", cfg=two_jobs())["index"] == {"errors": 0}


def test_quarantine_names_do_not_clash(spark, tmpdir_path):
    src = tmpdir_path / "sources"
    ws = P.Workspace(str(tmpdir_path / "ws"), str(src))
    mail = ("<a@x>", "L <j@linkedin.com>", "x", "Mon, 01 Jun 2026 10:00:00 +0200", LI)
    for folder in ("k1", "k2", "k3"):
        write_eml(src / folder / "same.eml", *mail)
    P.run_pipeline(spark, ws, "r1", "2026-06-02T10:00:00Z", cfg=two_jobs())
    write_eml(src / "k4" / "same.eml", *mail)
    write_eml(src / "k4" / "same_20260601120000.eml", *mail)
    P.run_pipeline(spark, ws, "r2", "2026-06-03T10:00:00Z", cfg=two_jobs())
    got = {r.path: r.quarantine_path for r in spark.read.parquet(ws.path("quarantine")).collect()}
    assert got == {"k2/same.eml": "_duplicates/same.eml", "k3/same.eml": "_duplicates/same_2.eml",
                   "k4/same.eml": "_duplicates/same_3.eml", "k4/same_20260601120000.eml": "_duplicates/same_20260601120000.eml"}


def _listing(spark, rows):
    import base64
    from datetime import datetime
    data = []
    for source_id, mid, sender, day, html in rows:
        msg = EmailMessage()
        msg["From"], msg["Message-ID"], msg["Date"], msg["Subject"] = sender, mid, f"{day} Jun 2026 10:00:00 +0000", "x"
        msg.set_content(html, subtype="html")
        data.append((source_id, sender, datetime(2026, 6, day, 10), base64.urlsafe_b64encode(bytes(msg)).decode()))
    return spark.createDataFrame(data, P.LISTING_SCHEMA)


def test_fetched_messages_are_indexed_and_marked(spark, tmpdir_path):
    ws = P.Workspace(str(tmpdir_path / "ws"), str(tmpdir_path / "none"))
    rows = [("g1", "<a@x>", "L <j@linkedin.com>", 5, LI), ("g2", "<b@x>", "T <n@alerts.talent.com>", 5, TC),
            ("g3", "<c@x>", "X <a@unknown.example>", 5, LI), ("g4", "<d@x>", "L <j@linkedin.com>", 1, LI)]
    r1 = P.run_pipeline(spark, ws, "r1", "2026-06-06T10:00:00Z", cfg=two_jobs(), listing=_listing(spark, rows), since_days=3)
    assert (r1["index"]["n_found"], r1["index"]["n_new"], r1["index"]["n_downloaded"]) == (2, 2, 2)
    assert r1["marked"] == 2
    assert sorted(r.gmail_id for r in spark.read.parquet(ws.path("to_mark")).collect()) == ["g1", "g2"]
    led = {r.message_id: r for r in LG.read_ledger(spark, ws.path("ledger")).collect()}
    assert led["<a@x>"]["gmail_id"] == "g1" and led["<a@x>"]["fetched_at"] == "2026-06-06T10:00:00Z"
    rows += [("g5", "<a@x>", "L <j@linkedin.com>", 6, LI), ("g6", "<f@x>", "L <j@linkedin.com>", 6, LI.replace("9876543210", "55"))]
    r2 = P.run_pipeline(spark, ws, "r2", "2026-06-07T10:00:00Z", cfg=two_jobs(), listing=_listing(spark, rows))
    assert (r2["index"]["n_found"], r2["index"]["n_new"], r2["index"]["n_downloaded"]) == (2, 2, 1)
    assert r2["marked"] == 1


def test_mark_cap_stops_a_run_before_it_publishes(spark, tmpdir_path):
    import os
    ws = P.Workspace(str(tmpdir_path / "ws"), str(tmpdir_path / "none"))
    rows = [(f"g{i}", f"<{i}@x>", "L <j@linkedin.com>", 5, LI) for i in range(3)]
    with pytest.raises(RuntimeError, match="safety cap"):
        P.run_pipeline(spark, ws, "r1", "2026-06-06T10:00:00Z", cfg=two_jobs(mark_cap=2), listing=_listing(spark, rows), since_days=3)
    assert not os.path.exists(ws.path("published"))


def test_a_replayed_run_replaces_its_rows_even_by_none(spark, tmpdir_path):
    path = str(tmpdir_path / "t")
    P._replace_run(spark.createDataFrame([("x",)], "a string"), path, "r1")
    P._replace_run(spark.createDataFrame([("y",)], "a string"), path, "r2")
    P._replace_run(spark.createDataFrame([], "a string"), path, "r1")
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("y", "r2")]


def test_geocode_reference(spark, tmpdir_path):
    src = tmpdir_path / "sources"
    write_eml(src / "linkedin" / "a.eml", "<a@x>", "L <j@linkedin.com>", "x", "Mon, 01 Jun 2026 10:00:00 +0200",
              li_card(1, "Bergère", "Alpage · Zzyzx"))
    ws = P.Workspace(str(tmpdir_path / "ws"), str(src))
    cfg = two_jobs(geocode=spark.createDataFrame([("Zzyzx", "05100")], "city string, postcode string"))
    P.run_pipeline(spark, ws, "r1", "2026-06-02T10:00:00Z", cfg=cfg)
    assert spark.read.parquet(ws.path("offers")).first()["Dept"] == "05"
