"""Per-provider extraction jobs (U1, X0-X8, X12): decoded mails -> raw offers.

Input: ``emails(message_id, provider_key, subject, html)``.  Output:
``offers_raw(message_id, offer_pos, provider_key, <ten raw-offer fields>)``.

Every job is a lazy DataFrame transformation: all matches of a template come
from ``regexp_extract_all`` (a look-ahead group captures the bounded
context that follows a match), are exploded with their position, and the
fields are scalar regex extracts on those small strings.  No Python UDF.
``extract_offers`` filters ``emails`` once per registered provider and
unions the branches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlake import fixed
from alertlake.functions import rx
from alertlake.functions import text as T
from alertlake.operators import links as L

WS = rx.space_class()
WSC = rx.space_chars()


def _strip(c: Column, chars: str | None = None) -> Column:
    """Python ``str.strip()`` (whitespace) or ``strip(chars)``."""
    cls = WS if chars is None else "[" + rx.escape(chars) + "]"
    return F.regexp_replace(c, f"^{cls}+|{cls}+$", "")


def base_offer(**fields: Column) -> list[Column]:
    """The ten raw fields, "" by default and ``url_qualite`` = vide."""
    out = []
    for f in fixed.RAW_OFFER_FIELDS:
        default = F.lit("vide") if f == "url_qualite" else F.lit("")
        out.append(F.coalesce(fields.get(f, default), default).alias(f))
    return out


def contract(text: Column, provider: str) -> Column:
    """Contract word of the provider's vocabulary."""
    return T.contract_type(text, fixed.CONTRACT_TERMS[provider])


def _finish(df: DataFrame, provider: str, **fields: Column) -> DataFrame:
    return df.select("message_id", F.col("pos").alias("offer_pos"),
                     F.lit(provider).alias("provider_key"), *base_offer(**fields))


# ---------------------------------------------------------------- X1 France Travail

FT_OFFER = (r'(?s)<a href="(https://candidat\.francetravail\.fr/offres/recherche/detail/([A-Z0-9]+))\?[^"]*"[^>]*>'
            + WS + r'*<span[^>]*>' + WS + r'*(.*?)' + WS + r'*<br' + WS + r'*/?>' + WS
            + r'*(?:<!--.*?-->' + WS + r'*)?(.*?)</span>' + WS + r'*</a>(?=(.{0,600}))')
FT_SPAN = r"<span[^>]*>([^<]*)</span>"
FT_LOC = r"^([0-9]{2})" + WS + "*-" + WS + r"*([^\n]+)"


def extract_france_travail(emails: DataFrame) -> DataFrame:
    # an offer id is marked seen before the row is validated (first match wins)
    m = L.explode_matches(emails, "html", FT_OFFER, {"url": 1, "oid": 2, "t_html": 3, "loc_html": 4, "ctx": 5},
                          ["message_id"], first_by=["oid"])
    titre = _strip(T.clean_entities(F.regexp_replace("t_html", "<[^>]+>", " ")))
    spans = F.transform(F.regexp_extract_all("loc_html", F.lit(FT_SPAN), 1),
                        lambda s: _strip(T.clean_entities(s), " -"))
    m = m.withColumn("_spans", spans).withColumn("_loc", F.get(F.filter("_spans", lambda s: s.rlike(FT_LOC)), 0))
    m = m.withColumn("_li", F.array_position("_spans", F.col("_loc")))
    others = F.filter("_spans", lambda s, i: i + 1 != F.col("_li"))
    has_loc = F.col("_loc").isNotNull()
    m = m.withColumn("titre", titre).withColumn("entreprise", F.when(has_loc, F.get(others, 0)))
    m = m.where((F.col("titre") != "") | (F.coalesce("entreprise", F.lit("")) != ""))
    return _finish(
        m, "france_travail", titre=F.col("titre"), entreprise=F.col("entreprise"),
        dept=F.when(has_loc, F.regexp_extract("_loc", FT_LOC, 1)),
        ville=F.when(has_loc, _strip(F.regexp_extract("_loc", FT_LOC, 2))),
        type_contrat=contract(T.clean_html(F.col("ctx")), "france_travail"),
        url=F.col("url"), url_qualite=F.lit("construite"),
        notes=F.concat(F.lit("Offre n°"), F.col("oid")))


# ---------------------------------------------------------------- X2 Indeed alerts

IA_BLOCK = (r'(?s)<h2[^>]*>' + WS + r'*<a href="([^"]+)"[^>]*>' + WS + r'*([^<]{3,120}?)' + WS + r'*</a>'
            + WS + r'*</h2>(?=(.*?)(?:<h2[^>]*>|\z))')
IA_INFO = (r'(?s)<td[^>]*style="[^"]*color:#2d2d2d;font-size:14px;line-height:21px[^"]*"[^>]*>'
           + WS + r'*([^<]{1,100}?)' + WS + r'*</td>')
IA_JK = r"jk=([a-f0-9]{16})"
IA_CITY = r"^(.+?)" + WS + r"*\(([0-9]{2})\)$"


def extract_indeed_alerte(emails: DataFrame) -> DataFrame:
    # Blocks are validated (title of 3+ characters) before the dedup on the
    # offer id (jk) or, without one, on (title, link); all on the row's array.
    zipped = F.arrays_zip(*[F.regexp_extract_all("html", F.lit(IA_BLOCK), g).alias(n)
                            for n, g in (("href", 1), ("t_raw", 2), ("body", 3))])
    blocks = F.transform(zipped, lambda m, i: F.struct(
        m["href"].alias("href"), m["body"].alias("body"), (i + 1).cast("bigint").alias("p"),
        _strip(T.clean_entities(m["t_raw"])).alias("titre"),
        F.regexp_extract(m["href"], IA_JK, 1).alias("jk")))
    valid = F.filter(blocks, lambda b: F.length(b["titre"]) >= 3)
    kept = L.first_in_array(valid, lambda b: F.when(
        b["jk"] != "", F.struct(F.lit(1).alias("k"), b["jk"].alias("a"), F.lit("").alias("b")))
        .otherwise(F.struct(F.lit(2).alias("k"), b["titre"].alias("a"), b["href"].alias("b"))))
    m = emails.select("message_id", F.explode(kept).alias("_b")).select(
        "message_id", F.col("_b.p").alias("pos"), F.col("_b.href").alias("href"), F.col("_b.body").alias("body"),
        F.col("_b.titre").alias("titre"), F.col("_b.jk").alias("_jk"))
    head = F.substring("body", 1, 1500)
    infos = F.regexp_extract_all(head, F.lit(IA_INFO), 1)
    lieu = _strip(T.clean_entities(F.get(infos, 1)))
    city_ok = lieu.rlike(IA_CITY)
    has_jk = F.col("_jk") != ""
    return _finish(
        m, "indeed_alerte", titre=F.col("titre"),
        entreprise=_strip(T.clean_entities(F.get(infos, 0))),
        ville=F.when(city_ok, _strip(F.regexp_extract(lieu, IA_CITY, 1))).otherwise(lieu),
        dept=F.when(city_ok, F.regexp_extract(lieu, IA_CITY, 2)),
        type_contrat=contract(T.clean_html(head), "indeed_alerte"),
        url=F.when(has_jk, F.concat(F.lit("https://fr.indeed.com/viewjob?jk="), F.col("_jk")))
        .otherwise(T.clean_entities(F.col("href"))),
        url_qualite=F.when(has_jk, F.lit("construite")).otherwise(F.lit("email")))


# ---------------------------------------------------------------- X3 Indeed match

IM_URL = r'href="(https://cts\.indeed\.com/v3/[^"]+)"'

IM_LOC = (r"(?s)^" + WS + r"*(?:([0-9]{5})" + WS + r"+([" + "A-Z\\x{C0}-\\x{178}" + r"][\w\x{E0}-\x{FF}\x{C0}-\x{178}'\-]*(?:["
          + WSC + r"\-][\w\x{E0}-\x{FF}\x{C0}-\x{178}'\-]+)*?)(?=" + WS
          + r"+(?:Salaire|Types? de postes?|Employeur réactif|Plusieurs postes))|([A-Z\x{C0}-\x{178}][^()]{1,40}?)"
          + WS + r"*\(([0-9]{2})\)|(Télétravail))")


def extract_indeed_match(emails: DataFrame) -> DataFrame:
    subj = F.coalesce(F.col("subject"), F.lit(""))
    parts = F.regexp_extract(subj, r"(?s)^(.*) – (.*)$", 0)
    has = parts != ""
    m = emails.select("message_id", "html",
                      F.when(has, _strip(F.regexp_extract(subj, r"(?s)^(.*) – (.*)$", 1))).alias("titre"),
                      F.when(has, _strip(F.regexp_extract(subj, r"(?s)^(.*) – (.*)$", 2))).alias("entreprise"),
                      T.clean_html(F.col("html")).alias("_text"))
    m = m.where(F.coalesce("titre", F.lit("")) != "")
    # the company as a literal, also where it holds the quoting's own end mark; without one there is no place
    literal = F.replace(F.col("entreprise"), F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    segs = F.when(F.col("entreprise") != "", F.regexp_extract_all(
        "_text", F.concat(F.lit("(?s)\\Q"), literal, F.lit("\\E(?=(.{0,160}))")), 1))
    seg = F.get(F.filter(segs, lambda s: s.rlike(rx.java(IM_LOC))), 0)
    g = lambda i: F.regexp_extract(seg, rx.java(IM_LOC), i)
    ville = (F.when(g(1) != "", _strip(g(2))).when(g(3) != "", _strip(g(3)))
             .when(g(5) != "", F.lit("Télétravail")))
    dept = F.when(g(1) != "", F.substring(g(1), 1, 2)).when(g(3) != "", g(4))
    url = F.regexp_extract("html", IM_URL, 1)
    m = m.withColumn("pos", F.lit(1).cast("bigint"))
    return _finish(m, "indeed_match", titre=F.col("titre"), entreprise=F.col("entreprise"),
                   ville=F.when(seg.isNotNull(), ville), dept=F.when(seg.isNotNull(), dept),
                   type_contrat=contract(F.col("_text"), "indeed_match"),
                   url=F.when(url != "", url), url_qualite=F.when(url != "", F.lit("email")))


# ---------------------------------------------------------------- X4 LinkedIn

LI_PAIR = r'jobs/view/([0-9]+)[^"]*"[^>]*>([^<]{5,100})</a>'
LI_INFO = (r'<p[^>]*class="[^"]*line-clamp-1[^"]*"[^>]*>' + WS + r'*([^<]+? · [^<]+?)' + WS + r'*</p>')


def extract_linkedin(emails: DataFrame) -> DataFrame:
    # a job id is marked seen before its title is validated (first match wins)
    # What surrounds the first link that begins with the job's id is cut out of the mail's blocks before the jobs are
    # exploded: none carries the mail, and the mail is not searched again for each.
    size = 6000  # characters after a link that may hold its place
    m = emails.select("message_id", "html", L.matches("html", LI_PAIR, {"job_id": 1, "t_raw": 2}, first_by=["job_id"]).alias("_jobs"),
                      L.blocks(F.col("html"), size).alias("_blocks")).where(F.size("_jobs") > 0)
    m = m.withColumn("_at", L.least_places(L.places(F.col("_blocks"), size, "jobs/view/"),
                                           F.transform("_jobs", lambda j: j["m"]["job_id"])))
    # an id of more digits than surely follow a link in its blocks is searched for
    searched = lambda j: F.instr(F.col("html"), F.concat(F.lit("jobs/view/"), j["m"]["job_id"])) - 1

    def around(at: Column) -> Column:
        b = F.floor(at / size).cast("int")
        three = F.concat(*[F.coalesce(F.get(F.col("_blocks"), b + k), F.lit("")) for k in (-1, 0, 1)])
        here = at % size + F.when(b > 0, size).otherwise(0)
        begin = F.greatest(here - 200, F.lit(0))
        return F.struct(F.regexp_extract(F.substring(three, here + 1, F.lit(size)), LI_INFO, 1).alias("info"),
                        F.substring(three, begin + 1, here + 500 - begin).alias("window"))

    jobs = F.zip_with("_jobs", "_at", lambda j, at: F.struct(
        j.alias("j"), L.bound(
            F.when(F.length(j["m"]["job_id"]) < size - 10, at).otherwise(searched(j)), around).alias("around")))
    m = m.select("message_id", F.explode(jobs).alias("_j")).select(
        "message_id", F.col("_j.j.p").alias("pos"), F.col("_j.j.m.job_id").alias("job_id"), F.col("_j.j.m.t_raw").alias("t_raw"),
        F.col("_j.around").alias("_around"))
    m = m.withColumn("titre", _strip(T.clean_entities(F.col("t_raw")))).where(F.length("titre") >= 5)
    info = _strip(T.clean_entities(F.col("_around.info")))
    company = F.substring_index(info, " · ", 1)
    lieu = F.when(F.instr(info, " · ") > 0, F.expr("substr(_info, instr(_info, ' · ') + 3)")).otherwise(F.lit(""))
    m = m.withColumn("_info", info)
    return _finish(
        m, "linkedin", titre=F.col("titre"),
        entreprise=F.when(F.col("_info") != "", _strip(company)),
        ville=F.when(F.col("_info") != "", _strip(F.regexp_replace(lieu, WS + r"*\([^)]*\)" + WS + "*$", ""))),
        type_contrat=contract(T.clean_html(F.col("_around.window")), "linkedin"),
        url=F.concat(F.lit("https://www.linkedin.com/jobs/view/"), F.col("job_id")),
        url_qualite=F.lit("construite"))


# ---------------------------------------------------------------- X5 Meteojob

MJ_SUBJECT = r"(?iu)^" + WS + r"*([^\n]+?)" + WS + r"+recrute un" + WS + r"+([^\n]+?)" + WS + r"*$"
MJ_URLS = [
    r'(?s)<a[^>]*class="hotoffer-cta-link"[^>]*href="(https://www\.meteojob\.com/jobs/[0-9]+\?[^"]{0,400})"',
    r'href="(https://www\.meteojob\.com/candidat/offres/offre-d-emploi-[^"]+)"',
    r'href="(https://www\.meteojob\.com/jobs/[0-9]+\?[^"]{0,400})"',
]
MJ_CITY = (r"(?U)\bVar" + WS + r"*\(([0-9]{2})\)|\b([A-Z\x{C0}-\x{178}][a-z\x{E0}-\x{FF}" + WSC + r"\-]+)"
           + WS + r"*\(([0-9]{2})\)")


def extract_meteojob_company(emails: DataFrame) -> DataFrame:
    subj = _strip(F.coalesce(F.col("subject"), F.lit("")))
    ok = subj.rlike(MJ_SUBJECT)
    url = F.coalesce(*[F.nullif(F.regexp_extract("html", p, 1), F.lit("")) for p in MJ_URLS])
    text = T.clean_html(F.col("html"))
    m = emails.select("message_id", "html", text.alias("_text"),
                      F.when(ok, _strip(F.regexp_extract(subj, MJ_SUBJECT, 1))).alias("entreprise"),
                      F.when(ok, _strip(F.regexp_extract(subj, MJ_SUBJECT, 2))).alias("titre"),
                      url.alias("_url"), F.lit(1).cast("bigint").alias("pos"))
    m = m.where((F.coalesce("titre", F.lit("")) != "") | (F.coalesce("entreprise", F.lit("")) != ""))
    g = lambda i: F.regexp_extract("_text", MJ_CITY, i)
    return _finish(
        m, "meteojob_company", titre=F.col("titre"), entreprise=F.col("entreprise"),
        dept=F.when(g(1) != "", g(1)).when(g(3) != "", g(3)),
        ville=F.when((g(1) == "") & (g(3) != ""), _strip(g(2))),
        type_contrat=contract(F.col("_text"), "meteojob_company"),
        url=T.clean_entities(F.col("_url")), url_qualite=F.when(F.col("_url").isNotNull(), F.lit("construite")))


# ---------------------------------------------------------------- X6 Jobijoba

JJ_TITLE = r'title="([^\n]+?) - ([^"' + WSC + r']+)"'
JJ_CLIC = r'<a[^>]*href="(https://emails\.jobijoba\.com/clic/[^"]+)"'
JJ_COMPANY = r"color:#000000[^>]*>([^<]{2,60})</span>"
JJ_CITY = r"(?s)</strong>.*?<span>" + WS + r"*([^<]{2,50}?)" + WS + r"*</span>"
JJ_SALARY_NUM = r"([0-9][0-9" + WSC + r"]+)" + WS + r"*<span itemprop=['\"]salaryCurrency['\"]>€</span>"
JJ_SALARY = JJ_SALARY_NUM + WS + r"*à" + WS + r"*" + JJ_SALARY_NUM + WS + r"*(par an|par mois)"


def extract_jobijoba(emails: DataFrame) -> DataFrame:
    # A card reaches from its title to the next one: the titles, and what stands between them.  All on the
    # row's own arrays: nothing is shuffled.
    m = emails.withColumn("_titles", F.regexp_extract_all("html", F.lit(JJ_TITLE), 0)).where(F.size("_titles") > 0)
    m = m.withColumn("_between", F.split("html", JJ_TITLE, -1))
    cards = F.zip_with("_titles", F.slice("_between", F.lit(2), F.size("_titles")), lambda a, b: F.concat(a, b))
    pieces = F.concat(F.slice("_between", 1, 1), cards)
    m = m.withColumn("_pieces", pieces)
    # A card's link opens before its title: the last link of all earlier pieces.
    last = F.transform("_pieces", lambda x: F.get(F.reverse(F.regexp_extract_all(x, F.lit(JJ_CLIC), 1)), 0))
    m = m.select("message_id", F.posexplode(F.arrays_zip(
        F.col("_titles").alias("title"), F.slice("_pieces", F.lit(2), F.size("_titles")).alias("block"),
        F.slice(L.filled_forward(last), F.lit(1), F.size("_titles")).alias("url"))).alias("_i", "_c"))
    m = m.withColumn("url", F.col("_c.url"))
    b = m.select("message_id", "url", (F.col("_i") + 1).cast("bigint").alias("pos"), F.col("_c.block").alias("block"),
                 _strip(T.clean_entities(F.regexp_extract("_c.title", JJ_TITLE, 1))).alias("titre"),
                 _strip(F.regexp_extract("_c.title", JJ_TITLE, 2)).alias("platform")).where(F.length("titre") >= 4)
    period = F.regexp_extract("block", JJ_SALARY, 3)
    factor = F.when(period == "par mois", F.lit(12)).otherwise(F.lit(1))
    amt = lambda g: (F.regexp_replace(F.regexp_extract("block", JJ_SALARY, g), WS, "").try_cast("bigint") * factor)
    company = F.regexp_extract("block", JJ_COMPANY, 1)
    ville = F.regexp_extract(F.substring("block", 1, 1000), JJ_CITY, 1)
    return _finish(
        b, "jobijoba_alerte", titre=F.col("titre"),
        entreprise=F.when(company != "", _strip(T.clean_entities(company))),
        ville=F.when(ville != "", _strip(T.clean_entities(ville))),
        salaire_min=F.when(period != "", amt(1).cast("string")),
        salaire_max=F.when(period != "", amt(2).cast("string")),
        type_contrat=contract(T.clean_html(F.substring("block", 1, 1500)), "jobijoba_alerte"),
        url=F.col("url"), url_qualite=F.when(F.col("url").isNotNull(), F.lit("email")),
        notes=F.when((F.col("platform") != "") & (F.col("platform") != "jobijoba.com"),
                     F.concat(F.lit("Via Jobijoba ("), F.col("platform"), F.lit(")"))))


# ---------------------------------------------------------------- X7 Talent.com

TC_TITLE = r"(<a[^>]+talent\.com[^>]*>)([^<]{5,100})</a>(?=((?s:.{0,2000})))"
TC_REDIRECT = r'href="(https://fr\.talent\.com/redirect\?id(?:=|&#x3D;)[a-f0-9]+[^"]{0,600})"'
TC_INFO = (r'(?s)<td[^>]*style="[^"]*color:' + WS + r'*#691f74[^"]*"[^>]*>' + WS + r'*([^<]{1,150}?)' + WS
           + r'*</td>' + WS + r'*.*?<td[^>]*style="[^"]*color:' + WS + r'*#30183f[^"]*"[^>]*>' + WS
           + r'*([^<]{0,150}?)' + WS + r'*</td>')


def extract_talent_com(emails: DataFrame) -> DataFrame:
    m = L.explode_matches(emails, "html", TC_TITLE, {"tag": 1, "t_raw": 2, "ctx": 3}, ["message_id"],
                          limit=fixed.TALENT_MAX_ANCHORS)  # first 20 anchors, before any filter
    m = m.withColumn("titre", _strip(T.clean_entities(F.col("t_raw"))))
    footer = F.array(*[F.lit(t) for t in fixed.TALENT_FOOTER_TITLES])
    m = m.where((F.length("titre") >= 5) & ~F.col("titre").contains("Afficher")
                & ~F.col("titre").contains("désabonner")
                & ~F.array_contains(footer, F.lower(F.regexp_replace("titre", r"[ ,.]+$", ""))))
    url = F.regexp_extract("tag", TC_REDIRECT, 1)
    lieu = _strip(T.clean_entities(F.regexp_extract("ctx", TC_INFO, 1)))
    has_info = F.col("ctx").rlike(TC_INFO)
    ent = _strip(T.clean_entities(F.regexp_extract("ctx", TC_INFO, 2)))
    return _finish(
        m, "talent_com", titre=F.col("titre"),
        url=F.when(url != "", T.clean_entities(url)), url_qualite=F.when(url != "", F.lit("email")),
        ville=F.when(has_info, _strip(F.substring_index(lieu, ",", 1))),
        entreprise=F.when(has_info & (ent != ""), ent),
        type_contrat=contract(F.col("titre"), "talent_com"))


# ---------------------------------------------------------------- U1 registry

EXTRACTORS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "france_travail": extract_france_travail,
    "indeed_alerte": extract_indeed_alerte,
    "indeed_match": extract_indeed_match,
    "linkedin": extract_linkedin,
    "meteojob_company": extract_meteojob_company,
    "jobijoba_alerte": extract_jobijoba,
    "talent_com": extract_talent_com,
}


def register_extractor(provider_key: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """Plug a new provider job in (a DataFrame -> DataFrame transformation)."""
    EXTRACTORS[provider_key] = fn


def extract_offers(emails: DataFrame, providers: list[str] | None = None) -> DataFrame:
    """Run each provider's job on its own mails and union the results."""
    keys = list(EXTRACTORS) if providers is None else providers
    out = None
    for k in keys:
        part = EXTRACTORS[k](emails.where(F.col("provider_key") == k))
        out = part if out is None else out.unionByName(part)
    return out
