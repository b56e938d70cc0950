"""Structured Streaming ingest (ST1-ST4): availableNow runs over a growing folder."""

from alertlake.plans import pipeline as P
from alertlake.sources import ledger as LG
from alertlake.streaming import ingest as S
from tests.test_extract import ia_card, li_card
from tests.test_pipeline import FT, LI, TC, two_jobs, write_eml

IA = ia_card("Analyste", "https://fr.indeed.com/rc/clk?jk=0123456789abcdef", ["Data Sud", "Nice (06)"])


def test_stream_runs(spark, tmpdir_path):
    src = tmpdir_path / "sources"
    write_eml(src / "linkedin" / "a.eml", "<a@x>", "L <j@linkedin.com>", "x", "Mon, 01 Jun 2026 10:00:00 +0200", LI)
    write_eml(src / "linkedin" / "b.eml", "<a@x>", "L <j@linkedin.com>", "x", "Mon, 01 Jun 2026 10:00:00 +0200", LI)
    write_eml(src / "talent-com" / "c.eml", "<c@x>", "T <n@alerts.talent.com>", "x", "Mon, 01 Jun 2026 11:00:00 +0200", TC)
    ws = P.Workspace(str(tmpdir_path / "ws"), str(src))
    ckpt = str(tmpdir_path / "ckpt")
    q = S.start(spark, ws, ckpt, now="2026-06-02T10:00:00Z")
    q.awaitTermination(300)
    led = LG.read_ledger(spark, ws.path("ledger"))
    assert sorted(r["message_id"] for r in led.collect()) == ["<a@x>", "<c@x>"]   # repeated id dropped
    offers = spark.read.parquet(ws.path("offers"))
    assert offers.count() == 2

    write_eml(src / "misc" / "d.eml", "<a@x>", "L <j@linkedin.com>", "x", "Mon, 01 Jun 2026 10:00:00 +0200", LI)
    write_eml(src / "linkedin" / "e.eml", "<e@x>", "L <j@linkedin.com>", "y", "Tue, 02 Jun 2026 10:00:00 +0200",
              LI.replace("9876543210", "1111111111"))
    q = S.start(spark, ws, ckpt, now="2026-06-03T10:00:00Z")
    q.awaitTermination(300)
    led = {r["message_id"]: r for r in LG.read_ledger(spark, ws.path("ledger")).collect()}
    assert sorted(led) == ["<a@x>", "<c@x>", "<e@x>"] and led["<e@x>"]["statut_extraction"] == "OK"
    offers = spark.read.parquet(ws.path("offers"))
    assert sorted(r["ID"] for r in offers.collect()) == ["E000001", "E000002", "E000003"]
    dup = offers.where("Message_ID = '<e@x>'").first()
    assert dup["Doublon_ID"] == "E000001"          # same key as the archived offer of an earlier batch
    assert spark.read.parquet(ws.path("published")).count() == 3

    q = S.start(spark, ws, ckpt, now="2026-06-04T10:00:00Z")      # nothing new
    q.awaitTermination(300)
    assert spark.read.parquet(ws.path("offers")).count() == 3


def test_stream_equals_batch(spark, tmpdir_path):
    """The same mail folder processed by the batch pipeline and by one
    availableNow stream run gives the same offers and the same ledger."""
    def fill(src):
        write_eml(src / "linkedin" / "a.eml", "<a@x>", "L <j@linkedin.com>", "x", "Mon, 01 Jun 2026 10:00:00 +0200", LI)
        write_eml(src / "talent-com" / "b.eml", "<b@x>", "T <n@alerts.talent.com>", "x", "Mon, 01 Jun 2026 09:00:00 +0000", TC)
        write_eml(src / "france-travail" / "c.eml", "<c@x>", "FT <n@offre.francetravail.fr>", "x",
                  "Tue, 02 Jun 2026 08:00:00 +0200", FT + FT)
        write_eml(src / "indeed" / "d.eml", "<d@x>", "I <a@jobalert.indeed.com>", "x", "Tue, 02 Jun 2026 07:00:00 +0200", IA)
        write_eml(src / "misc" / "e.eml", "<e@x>", "X <a@unknown.example>", "?", "Tue, 02 Jun 2026 08:00:00 +0200", "<p/>")

    cols = ["ID", "Source", "Titre", "Entreprise", "Cle_dedup", "Doublon_ID", "Ville", "Dept", "URL", "Message_ID"]
    fill(tmpdir_path / "s1")
    fill(tmpdir_path / "s2")
    wb = P.Workspace(str(tmpdir_path / "wb"), str(tmpdir_path / "s1"))
    P.run_pipeline(spark, wb, "r1", "2026-06-03T10:00:00Z")
    ws = P.Workspace(str(tmpdir_path / "ws"), str(tmpdir_path / "s2"))
    S.start(spark, ws, str(tmpdir_path / "ck"), now="2026-06-03T10:00:00Z").awaitTermination(300)
    batch = sorted(tuple(r) for r in spark.read.parquet(wb.path("offers")).select(*cols).collect())
    stream = sorted(tuple(r) for r in spark.read.parquet(ws.path("offers")).select(*cols).collect())
    assert batch == stream and len(batch) == 4
    lcols = ["message_id", "fichier", "date_email", "statut_extraction"]
    lb = sorted(tuple(r) for r in LG.read_ledger(spark, wb.path("ledger")).select(*lcols).collect())
    ls = sorted(tuple(r) for r in LG.read_ledger(spark, ws.path("ledger")).select(*lcols).collect())
    assert lb == ls


DAY = "Mon, 01 Jun 2026 10:00:00 +0200"
SENDER = "L <j@linkedin.com>"


def test_a_committed_batch_may_be_replayed(spark, tmpdir_path):
    """Spark's record of the last batch is lost, ours is not: the batch is read again, and changes nothing."""
    src, ckpt = tmpdir_path / "sources", tmpdir_path / "ckpt"
    ws = P.Workspace(str(tmpdir_path / "ws"), str(src))
    write_eml(src / "a.eml", "<a@x>", SENDER, "x", DAY, LI)
    S.start(spark, ws, str(ckpt), cfg=two_jobs(), now="2026-06-02T10:00:00Z").awaitTermination(300)
    write_eml(src / "b.eml", "<b@x>", SENDER, "x", DAY, li_card(11, "Relieur"))
    S.start(spark, ws, str(ckpt), cfg=two_jobs(), now="2026-06-02T11:00:00Z").awaitTermination(300)
    commits = sorted((p for p in (ckpt / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last = commits[-1]
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    write_eml(src / "c.eml", "<c@x>", SENDER, "x", DAY, li_card(12, "Doreur"))
    S.start(spark, ws, str(ckpt), cfg=two_jobs(), now="2026-06-02T12:00:00Z").awaitTermination(300)
    offers = spark.read.parquet(ws.path("offers")).collect()
    assert sorted((r["ID"], r["Message_ID"]) for r in offers) == [("E000001", "<a@x>"), ("E000002", "<b@x>"), ("E000003", "<c@x>")]
    assert spark.read.parquet(ws.path("published")).count() == 3


def test_two_queries_share_a_workspace(spark, tmpdir_path):
    ws1 = P.Workspace(str(tmpdir_path / "ws"), str(tmpdir_path / "s1"))
    ws2 = P.Workspace(str(tmpdir_path / "ws"), str(tmpdir_path / "s2"))
    write_eml(tmpdir_path / "s1" / "a.eml", "<a@x>", SENDER, "x", DAY, LI)
    write_eml(tmpdir_path / "s2" / "b.eml", "<b@x>", SENDER, "x", DAY, li_card(21, "Luthier"))
    S.start(spark, ws1, str(tmpdir_path / "c1"), cfg=two_jobs(), now="2026-06-02T10:00:00Z").awaitTermination(300)
    S.start(spark, ws2, str(tmpdir_path / "c2"), cfg=two_jobs(), now="2026-06-02T11:00:00Z").awaitTermination(300)
    rows = spark.read.parquet(ws1.path("offers")).collect()
    assert sorted((r["ID"], r["Message_ID"]) for r in rows) == [("E000001", "<a@x>"), ("E000002", "<b@x>")]
    assert spark.read.parquet(ws1.path("published")).count() == 2


def test_mails_without_id_are_all_reported(spark, tmpdir_path):
    ws = P.Workspace(str(tmpdir_path / "ws"), str(tmpdir_path / "s"))
    for i in range(3):
        write_eml(tmpdir_path / "s" / f"{i}.eml", None, SENDER, "x", DAY, LI)
    S.start(spark, ws, str(tmpdir_path / "c"), cfg=two_jobs(), now="2026-06-02T10:00:00Z").awaitTermination(300)
    assert spark.read.parquet(ws.path("index_errors")).count() == 3
