"""One test per behaviour trap of SURVEY §1.1 not covered elsewhere."""

import re

from pyspark.sql import functions as F

from alertlake import fixed
from alertlake.operators import dedup, enrich, geo, skew
from alertlake.operators import extract as X
from alertlake.operators import publish as PB
from alertlake.sources import dims


def _cities(spark, strict):
    return geo.resolve_cities(
        spark.createDataFrame([("Montbéliard",), ("Marcq-en-Barœul",), ("La Rochelle",), ("Saint Denis",),
                               ("  Toulon ",), ("Inconnueville",)], "ville string"),
        dims.city_dim(spark, fixed.CITY_DEPT, strict_compat=strict))


def test_q3_accented_keys_and_q4_first_word(spark):
    out = {r["ville"]: (r["Dept"], r["dept_method"]) for r in _cities(spark, True).collect()}
    assert out["Montbéliard"] == ("", "none")          # Q3: accented key without a plain twin
    assert out["Marcq-en-Barœul"] == ("59", "exact")    # œ does not decompose
    assert out["La Rochelle"] == ("83", "prefix")       # Q4: first entry starting with "la"
    assert out["Saint Denis"] == ("35", "prefix")
    assert out["  Toulon "] == ("83", "exact")
    assert out["Inconnueville"] == ("", "none")
    loose = {r["ville"]: r["Dept"] for r in _cities(spark, False).collect()}
    assert loose["Montbéliard"] == "25"


def test_q1_first_or_last_archived_row(spark):
    arch = spark.createDataFrame([(1, "E000001", "k"), (2, "E000002", "k")], "ord int, ID string, Cle_dedup string")
    last = {r["Cle_dedup"]: r["_arch_id"] for r in dedup.key_map(arch, canonical="last").collect()}
    first = {r["Cle_dedup"]: r["_arch_id"] for r in dedup.key_map(arch, canonical="first").collect()}
    assert last == {"k": "E000002"} and first == {"k": "E000001"}


def test_q17_hot_placeholder_key_is_not_shuffled(spark, monkeypatch):
    """A third of the offers share the placeholder key: its rows are joined by broadcast where they are, the
    others by shuffle, and every later row still links to the first one."""
    monkeypatch.setattr(skew, "DEFAULT_HOT_ROWS", 50)
    n = 600
    raw = spark.range(n).select(
        F.lit("<m>").alias("message_id"), F.col("id").alias("offer_pos"), F.lit("linkedin").alias("provider_key"),
        F.lit("2026-06-01").alias("date_email"),
        F.when(F.col("id") % 3 == 0, F.lit("(H/F)")).otherwise(F.concat(F.lit("Poste "), F.col("id").cast("string"))).alias("titre"),
        *[F.lit("").alias(c) for c in ["entreprise", "ville", "dept", "type_contrat", "salaire_min",
                                       "salaire_max", "url", "notes"]],
        F.lit("vide").alias("url_qualite"))
    rows = enrich.offer_rows(raw)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # The join back of the statistics: for hot keys a broadcast of at most 1 000 rows, for the rest a join by key.
    union = plan[plan.index("Union"):]
    warm, cold = re.split(r"\n   [+:]- ", union)[1:3]
    assert "BroadcastHashJoin" in warm and "hashpartitioning(Cle_dedup" not in warm.split("BroadcastExchange")[0]
    assert "Cle_dedup" in cold
    hot = rows.where(F.col("Cle_dedup") == "inconnu|inconnue|inconnu")
    assert hot.count() == n // 3
    assert hot.where(F.col("Doublon_ID") == "").count() == 1
    assert hot.where(F.col("Doublon_ID") != "").select("Doublon_ID").distinct().collect()[0][0] == "E000001"
    assert rows.count() == n


def test_q9_duplicates_and_blacklisted_are_kept(spark):
    raw = spark.createDataFrame(
        [("<m>", 1, "linkedin", "d", "Nounou", "A"), ("<m>", 2, "linkedin", "d", "Nounou", "A"),
         ("<m>", 3, "linkedin", "d", "", "A")],
        "message_id string, offer_pos int, provider_key string, date_email string, titre string, entreprise string")
    for c in ["ville", "dept", "type_contrat", "salaire_min", "salaire_max", "url", "notes"]:
        raw = raw.withColumn(c, F.lit(""))
    raw = raw.withColumn("url_qualite", F.lit("vide"))
    rows = {r["ID"]: r for r in enrich.offer_rows(raw).collect()}
    assert sorted(rows) == ["E000001", "E000002"]               # empty title takes no ID
    assert rows["E000002"]["Doublon_ID"] == "E000001"
    assert rows["E000001"]["Notes"] == "⛔ Blacklisté: nounou"
    assert rows["E000001"]["Raison_exclusion"] == "Blacklisté: nounou"
    st = {r["message_id"]: r["statut_extraction"] for r in enrich.mail_status(raw).collect()}
    assert st == {"<m>": "PARTIEL"}


def test_q15_history_counts_only_ok_files(spark):
    stats = spark.createDataFrame([(2, 3, 1, 0, 7, 1, 0, False)],
                                  "fichiers_ok long, fichiers_partiel long, erreurs long, ignores long, "
                                  "offres_ecrites long, doublons long, blacklistes long, dry_run boolean")
    h = PB.history_row(stats, "2026-06-02T10:00:00").first()
    assert h["Fichiers_traites"] == 2 and h["Offres_extraites"] == 7


def test_q18_seen_before_or_after_validation(spark):
    # LinkedIn: the first anchor of an id has a too-short title: the id is
    # already seen, so its later valid anchor is not used either.
    li = ('<a href="https://www.linkedin.com/jobs/view/42/">&amp;&amp;&amp;</a>'
          '<a href="https://www.linkedin.com/jobs/view/42/?x=1">Ingénieur Qualité</a>')
    df = spark.createDataFrame([("<m>", "linkedin", "", li)], "message_id string, provider_key string, subject string, html string")
    assert X.extract_linkedin(df).count() == 0
    # Indeed: blocks are validated first, so a short first title does not hide the offer.
    ia = ('<h2><a href="https://x/?jk=0123456789abcdef">Go</a></h2>'
          '<h2><a href="https://x/?jk=0123456789abcdef">Analyste</a></h2>')
    df = spark.createDataFrame([("<m>", "indeed_alerte", "", ia)], "message_id string, provider_key string, subject string, html string")
    assert [r["titre"] for r in X.extract_indeed_alerte(df).collect()] == ["Analyste"]
