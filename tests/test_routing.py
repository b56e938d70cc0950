"""Provider routing (R1-R3, J1, J2, R9) on small dimensions."""

from pyspark.sql import functions as F

from alertlake.operators import route as R
from alertlake.sources import dims

PROVIDERS = [("indeed_alerte", "indeed", ["jobalert.indeed.com", "indeed.com"], False),
             ("indeed_match", "indeed", ["match.indeed.com"], False),
             ("meteojob_company", "meteojob", ["meteojob.com"], False),
             ("meteojob_digest", "meteojob", ["meteojob.com"], True)]


def test_detect_and_folder(spark):
    pdim = dims.provider_dim(spark, PROVIDERS)
    mails = spark.createDataFrame([(1, "a.match.indeed.com"), (2, "jobalert.indeed.com"), (3, "x.indeed.com"),
                                   (4, "meteojob.com"), (5, "unknown.org"), (6, "")], "id int, sender_domain string")
    out = {r["id"]: (r["provider_key"], r["match_parts"]) for r in R.detect_provider(mails, pdim).collect()}
    assert out[1] == ("indeed_match", 3)
    assert out[2] == ("indeed_alerte", 3)
    assert out[3] == ("indeed_alerte", 2)
    assert out[4] == ("meteojob_company", 2)      # Q2: first config entry wins the tie
    assert out[5] == (None, None) and out[6] == (None, None)
    folders = {r["id"]: r["expected_folder"] for r in
               R.expected_folder(mails, dims.domain_folder_map(pdim)).collect()}
    assert folders[1] == "indeed" and folders[5] is None


def test_active_domains_and_dispatch(spark):
    pdim = dims.provider_dim(spark, PROVIDERS)
    act = sorted(r[0] for r in dims.active_domains(pdim).collect())
    assert act == ["indeed.com", "jobalert.indeed.com", "match.indeed.com", "meteojob.com"]
    routed = spark.createDataFrame(
        [("a", None, None, True), ("b", "meteojob_digest", True, True), ("c", "hellowork", False, True),
         ("d", "linkedin", False, True), ("e", "linkedin", False, False)],
        "m string, provider_key string, skip boolean, present boolean")
    out = {r["m"]: (r["dispatch_status"], r["dispatch_reason"]) for r in
           R.dispatch(routed, file_present=F.col("present")).collect()}
    assert out == {"a": ("ERREUR", "unknown_provider"), "b": ("IGNORE", "skip"),
                   "c": ("IGNORE", "no_extractor"), "d": (None, None), "e": ("ERREUR", "missing_file")}


def test_providers_from_json(spark, tmp_path):
    p = tmp_path / "patterns.json"
    p.write_text('{"_comment": "x", "a": {"folder": "fa", "sender_domains": ["A.com"]}}', encoding="utf-8")
    assert dims.providers_from_json(spark, f"file://{p}") == dims.providers_from_json(spark, p) == [("a", "fa", ["A.com"], False)]
    assert dims.providers_from_json(spark, tmp_path / "missing.json") == []


def test_file_action(spark):
    df = spark.createDataFrame([(None, "p/a.eml", "a.eml"), (None, "p/20240101-1000-a.eml", "20240101-1000-a.eml"),
                                ("p/a.eml", "p/a.eml", "a.eml"),
                                ("p/20240101-1000-a.eml", "p/20240101-1000-a.eml", "20240101-1000-a.eml"),
                                ("p/x.eml", "p/a.eml", "a.eml")], "known string, path string, name string")
    out = [r[0] for r in df.select(R.file_action(F.col("known"), F.col("path"), F.col("name"))).collect()]
    assert out == ["rename", "reindex", "rename", "reindex", "duplicate"]


def test_canonical_names_collisions(spark):
    ren = spark.createDataFrame([("p", "20240101-1000-a", "p/x1.eml"), ("p", "20240101-1000-a", "p/x2.eml"),
                                 ("p", "20240101-1000-a", "p/x3.eml"), ("q", "20240101-1000-a", "q/x.eml")],
                                "folder string, base string, path string")
    existing = spark.createDataFrame([("p", "20240101-1000-a.eml"), ("p", "20240101-1000-a_3.eml")],
                                     "folder string, name string")
    out = {r["path"]: r["new_name"] for r in R.canonical_names(ren, existing).collect()}
    assert out == {"p/x1.eml": "20240101-1000-a_2.eml", "p/x2.eml": "20240101-1000-a_4.eml",
                   "p/x3.eml": "20240101-1000-a_5.eml", "q/x.eml": "20240101-1000-a.eml"}


def test_canonical_names_exact_names_only(spark):
    ren = spark.createDataFrame([("p", "b", "p/1.eml"), ("p", "b", "p/2.eml")], "folder string, base string, path string")
    existing = spark.createDataFrame([("p", "b.eml"), ("p", "b_02.eml"), ("p", "b_1.eml"), ("p", "b_2.eml"),
                                      ("p", "b_3.eml"), ("p", "other.eml")], "folder string, name string")
    out = {r["path"]: r["new_name"] for r in R.canonical_names(ren, existing).collect()}
    assert out == {"p/1.eml": "b_4.eml", "p/2.eml": "b_5.eml"}
