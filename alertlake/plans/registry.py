"""Query registry: one Spark query per operator, each with its SQL oracle.

Every query reads whole driver tables (through ``alertlake.plans.views``)
and returns an unordered DataFrame whose column names equal the oracle's.
User-editable dimensions (keywords, blacklist, contract words, provider
domains) are passed the way a user would: the package defaults extended
with entries that occur in the driver corpus.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlake import fixed
from alertlake.functions import text as T
from alertlake.operators import dedup
from alertlake.operators import links as L
from alertlake.operators import route as R
from alertlake.operators import enrich as EN
from alertlake.operators import fetch as FE
from alertlake.operators import publish as PB
from alertlake.operators import geo as G
from alertlake.functions import rx
from alertlake.sources import dims
from alertlake.sources import ledger as LG
from alertlake.sources import mail as M
from alertlake.sources import offers_io as IO
from alertlake.sources.archive import Archive
from alertlake.plans import sqlx
from alertlake.plans import views as V
from alertlake.session import ensure_checkpoint_dir, keep, materialize, memo

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# User dimensions for the corpus (package defaults first, config order kept).
CORPUS_STACK = {**fixed.STACK_KEYWORDS,
                "Corpus-EN": ["the", "and"], "Corpus-DE": ["der", "und"],
                "Corpus-FR": ["une", "des"], "Corpus-ES": ["los", "por"]}
CORPUS_BLACKLIST = fixed.TITLE_BLACKLIST + ["été", "über", "ción", "ness"]
CORPUS_CONTRACTS = fixed.CONTRACT_TERMS["france_travail"] + ["Été", "Über", "And", "Por"]

# ---------------------------------------------------------------- text


@register("q_strip_accents", "SELECT doc_id, strip_accents(text) AS folded FROM documents")
def q_strip_accents(spark, d):
    return V.table(spark, d, "documents", text_work=True).select("doc_id", T.strip_accents(F.col("text")).alias("folded"))


@register("q_normalize", f"SELECT doc_id, {sqlx.normalize('text')} AS norm_text FROM documents")
def q_normalize(spark, d):
    return V.table(spark, d, "documents", text_work=True).select("doc_id", T.normalize(F.col("text")).alias("norm_text"))


@register("q_clean_html", f"SELECT page_id, {sqlx.clean_html('html')} AS page_text FROM pages")
def q_clean_html(spark, d):
    return V.table(spark, d, "pages", text_work=True).select("page_id", T.clean_html(F.col("html")).alias("page_text"))


@register("q_title_slug", V.with_ctes(V.SQL_DOC_OFFERS, body=f"SELECT ord, {sqlx.title_slug('titre')} AS slug FROM doc_offers"))
def q_title_slug(spark, d):
    return V.doc_offers(spark, d).select("ord", T.title_slug(F.col("titre")).alias("slug"))


@register("q_dedup_key", V.with_ctes(V.SQL_DOC_OFFERS, body=f"SELECT ord, {sqlx.dedup_key('entreprise', 'ville', 'titre')} AS \"Cle_dedup\" FROM doc_offers"))
def q_dedup_key(spark, d):
    o = V.doc_offers(spark, d)
    return o.select("ord", T.dedup_key(F.col("entreprise"), F.col("ville"), F.col("titre")).alias("Cle_dedup"))


@register("q_blacklist", f"SELECT doc_id, {sqlx.blacklist_term('text', CORPUS_BLACKLIST)} AS blacklist_term FROM documents")
def q_blacklist(spark, d):
    return V.table(spark, d, "documents", text_work=True).select(
        "doc_id", T.blacklist_term(F.col("text"), CORPUS_BLACKLIST).alias("blacklist_term"))


@register("q_stack_tags", f"SELECT doc_id, {sqlx.stack_tags('text', CORPUS_STACK)} AS \"Stack\" FROM documents")
def q_stack_tags(spark, d):
    return V.table(spark, d, "documents", text_work=True).select("doc_id", T.stack_tags(F.col("text"), CORPUS_STACK).alias("Stack"))


@register("q_contract_type", f"SELECT doc_id, {sqlx.contract_type('text', CORPUS_CONTRACTS)} AS \"Type_contrat\" FROM documents")
def q_contract_type(spark, d):
    return V.table(spark, d, "documents", text_work=True).select(
        "doc_id", T.contract_type(F.col("text"), CORPUS_CONTRACTS).alias("Type_contrat"))


@register("q_subject_slug", f"SELECT doc_id, {sqlx.subject_slug('text')} AS subject_slug FROM documents")
def q_subject_slug(spark, d):
    return V.table(spark, d, "documents", text_work=True).select("doc_id", T.subject_slug(F.col("text")).alias("subject_slug"))


@register("q_b64_landing", """
SELECT item_id, raw, decode(from_base64(translate(raw, '-_', '+/'))) AS decoded
FROM (SELECT item_id, translate(to_base64(encode(text)), '+/', '-_') AS raw FROM benchmark)""")
def q_b64_landing(spark, d):
    """URL-safe base64 message payloads landed as a table, decoded in Spark."""
    b = V.table(spark, d, "benchmark", text_work=True)
    # base64() may wrap lines (MIME style); the landed payload is one line.
    b64 = F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"[\r\n]", "")
    landed = b.select("item_id", F.translate(b64, "+/", "-_").alias("raw"))
    return landed.select("item_id", "raw",
                         F.decode(FE.payload(F.col("raw")), "UTF-8").alias("decoded"))


# ---------------------------------------------------------------- links

@register("q_page_links", V.with_ctes(V.SQL_PAGE_LINKS, body="SELECT page_id, pos, href, anchor_text FROM page_links"))
def q_page_links(spark, d):
    return V.page_links(spark, d).select("page_id", "pos", "href", "anchor_text")


TOPK_RE = r'<a [^>]*href="([^"]*)"[^>]*>([^<]{5,100})</a>'
FOOTER_SQL = "[" + ", ".join(sqlx.q(t) for t in fixed.TALENT_FOOTER_TITLES) + "]"


@register("q_topk_links", f"""
SELECT page_id, i::BIGINT AS pos, hs[i] AS href, ts[i] AS title
FROM (SELECT page_id, regexp_extract_all(html, '{TOPK_RE}', 1) AS hs,
             regexp_extract_all(html, '{TOPK_RE}', 2) AS ts FROM pages) x,
     range(1, least(len(hs), {fixed.TALENT_MAX_ANCHORS}) + 1) r(i)
WHERE NOT list_contains({FOOTER_SQL}, lower(rtrim(trim(ts[i]), ' ,.')))""")
def q_topk_links(spark, d):
    """O2: first 20 anchors with a 5-100 character text per page, cut before
    the footer-title filter (the template's order)."""
    m = L.explode_matches(V.table(spark, d, "pages", text_work=True), "html", TOPK_RE, {"href": 1, "title": 2},
                          ["page_id"], limit=fixed.TALENT_MAX_ANCHORS)
    footer = F.array(*[F.lit(t) for t in fixed.TALENT_FOOTER_TITLES])
    key = F.lower(F.regexp_replace(F.trim(F.col("title")), r"[ ,.]+$", ""))
    return m.where(~F.array_contains(footer, key))


CF_RE = r'<a [^>]*href="([^"]*)"|<p>([^<]+)'


@register("q_carry_forward", f"""
SELECT page_id, pos, para, last_href FROM (
  SELECT page_id, pos, para,
         last_value(nullif(href, '') IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_href
  FROM (SELECT page_id, i::BIGINT AS pos, hs[i] AS href, ps[i] AS para
        FROM (SELECT page_id, regexp_extract_all(html, '{CF_RE}', 1) AS hs,
                     regexp_extract_all(html, '{CF_RE}', 2) AS ps FROM pages) x,
             range(1, len(hs) + 1) r(i)) t) u
WHERE para <> ''""")
def q_carry_forward(spark, d):
    """The last link seen before each paragraph (a card's link opens before its title)."""
    tok = L.explode_matches(V.table(spark, d, "pages", text_work=True), "html", CF_RE, {"href": 1, "para": 2}, ["page_id"])
    out = L.carry_forward_last(tok, ["page_id"], "pos", F.col("href"), "last_href")
    return out.where(F.col("para") != "").select("page_id", "pos", "para", "last_href")


@register("q_within_dedup", V.with_ctes(V.SQL_PAGE_LINKS, body="""
SELECT page_id, href, min(pos) AS pos, arg_min(anchor_text, pos) AS anchor_text
FROM page_links GROUP BY page_id, href"""))
def q_within_dedup(spark, d):
    """First occurrence of each link target within a page."""
    first = L.explode_matches(V.table(spark, d, "pages", text_work=True), "html", V.LINK_RE, {"href": 1, "anchor_text": 2},
                              ["page_id"], first_by=["href"])
    return first.select("page_id", "href", "pos", "anchor_text")


HOST_RE = r"^[a-z]+://([^/:?#]+)"
NATIVE_ID_RE = r"^/([A-Za-z0-9]+)$"


@register("q_url_quality", V.with_ctes(V.SQL_PAGE_LINKS, body=f"""
SELECT page_id, pos,
       CASE WHEN nid <> '' THEN 'https://' || host || '/view/' || nid
            WHEN href <> '' THEN {sqlx.clean_entities('href')} ELSE '' END AS "URL",
       CASE WHEN nid <> '' THEN 'construite' WHEN href <> '' THEN 'email' ELSE 'vide' END AS "URL_qualite"
FROM (SELECT *, regexp_extract(href, '{NATIVE_ID_RE}', 1) AS nid,
             regexp_extract(url, '{HOST_RE}', 1) AS host FROM page_links) t"""))
def q_url_quality(spark, d):
    """X11: canonical URL from a native id found in the link, else the link as is."""
    links = V.page_links(spark, d)
    nid = F.regexp_extract("href", NATIVE_ID_RE, 1)
    prefix = F.concat(F.lit("https://"), F.regexp_extract("url", HOST_RE, 1), F.lit("/view/"))
    url, quality = L.url_quality(nid, prefix, F.col("href"))
    return links.select("page_id", "pos", url.alias("URL"), quality.alias("URL_qualite"))


# ---------------------------------------------------------------- IDs and duplicates

@register("q_assign_ids", V.with_ctes(V.SQL_DOC_OFFERS, body="""
SELECT ord, seq, printf('E%06d', seq) AS "ID"
FROM (SELECT ord, row_number() OVER (ORDER BY ville, ord)::BIGINT AS seq FROM doc_offers) t"""))
def q_assign_ids(spark, d):
    """W1 + T9: global (ville, ord) order numbering without a single-partition sort."""
    o = V.doc_offers(spark, d).select("ord", "ville")
    ided = dedup.assign_ordered_ids(o, ["ville", "ord"], out_col="seq")
    return ided.select("ord", "seq", T.format_offer_id(F.col("seq")).alias("ID"))


SQL_KEYED = V.SQL_DOC_OFFERS + """,
keyed AS (SELECT ord, "ID", archived, """ + sqlx.dedup_key("entreprise", "ville", "titre") + """ AS cle FROM doc_offers)"""


def _keyed(spark, d):
    o = V.doc_offers(spark, d)
    arch = V.archived_doc_ids(spark, d).distinct().withColumn("archived", F.lit(True))
    o = o.join(arch, "ord", "left").withColumn("archived", F.coalesce("archived", F.lit(False)))
    # Compact keyed rows (no text), kept once: the key map, the duplicate
    # links and the counts all read them several times.
    return keep(o.select("ord", "ID", "archived",
                         T.dedup_key(F.col("entreprise"), F.col("ville"), F.col("titre")).alias("Cle_dedup")))


@register("q_key_map", V.with_ctes(SQL_KEYED, body="""
SELECT cle AS "Cle_dedup", arg_max("ID", ord) AS "ID" FROM keyed WHERE archived GROUP BY cle"""))
def q_key_map(spark, d):
    """A3: archive key -> ID (last archived row wins)."""
    k = _keyed(spark, d).where("archived")
    return dedup.key_map(k, canonical="last").withColumnRenamed("_arch_id", "ID")


@register("q_dup_link", V.with_ctes(SQL_KEYED, body="""
SELECT b.ord, b."ID", b.cle AS "Cle_dedup",
       coalesce(a.arch_id, CASE WHEN b."ID" <> f.first_id THEN f.first_id END, '') AS "Doublon_ID"
FROM keyed b
JOIN (SELECT cle, arg_min("ID", ord) AS first_id FROM keyed WHERE NOT archived GROUP BY cle) f USING (cle)
LEFT JOIN (SELECT cle, arg_max("ID", ord) AS arch_id FROM keyed WHERE archived GROUP BY cle) a USING (cle)
WHERE NOT b.archived"""))
def q_dup_link(spark, d):
    """W2 + J6: link new offers to the archived ID of their key, else to the
    first new offer of the key."""
    k = _keyed(spark, d)
    batch = k.where(~F.col("archived")).drop("archived")
    arch = k.where("archived").select("Cle_dedup", "ID", "ord")
    return dedup.link_duplicates(batch, archive=arch, canonical="last").select("ord", "ID", "Cle_dedup", "Doublon_ID")


@register("q_dup_count", V.with_ctes(SQL_KEYED, body="""
SELECT ord, cle AS "Cle_dedup", count(*) OVER (PARTITION BY cle) AS dup_count,
       count(*) OVER (PARTITION BY cle) > 1 AS is_duplicate FROM keyed"""))
def q_dup_count(spark, d):
    """Rows per dedup key (``COUNTIF(key) > 1``), skew-safe."""
    k = _keyed(spark, d).select("ord", "Cle_dedup")
    out = dedup.duplicate_count(k, "Cle_dedup")
    return out.withColumn("is_duplicate", F.col("dup_count") > 1)


SQL_ID_STRINGS = """ids AS (
  SELECT doc_id, CASE lang WHEN 'en' THEN printf('E%06d', doc_id) WHEN 'fr' THEN 'E' || source
                 WHEN 'de' THEN 'E' || n_chars::VARCHAR ELSE source END AS id_str FROM documents)"""


def _id_strings(spark, d):
    doc = V.table(spark, d, "documents")
    s = (F.when(F.col("lang") == "en", T.format_offer_id(F.col("doc_id")))
         .when(F.col("lang") == "fr", F.concat(F.lit("E"), F.col("source")))
         .when(F.col("lang") == "de", F.concat(F.lit("E"), F.col("n_chars").cast("string")))
         .otherwise(F.col("source")))
    return doc.select("doc_id", s.alias("id_str"))


@register("q_id_parse", V.with_ctes(SQL_ID_STRINGS, body="""
SELECT doc_id, id_str,
       CASE WHEN starts_with(id_str, 'E') THEN TRY_CAST(substr(id_str, 2) AS BIGINT) END AS id_num,
       regexp_matches(id_str, '^E[0-9]+$') AS strict_ok
FROM ids"""))
def q_id_parse(spark, d):
    """Lenient parse (NULL when malformed) and the strict format check."""
    ids = _id_strings(spark, d)
    return ids.select("doc_id", "id_str", T.parse_offer_id_lenient(F.col("id_str")).alias("id_num"),
                      F.col("id_str").rlike(r"^E[0-9]+$").alias("strict_ok"))


@register("q_max_offer_id", V.with_ctes(SQL_ID_STRINGS, body="""
SELECT coalesce(max(CASE WHEN starts_with(id_str, 'E') THEN TRY_CAST(substr(id_str, 2) AS BIGINT) END), 0) AS max_id
FROM ids"""))
def q_max_offer_id(spark, d):
    """A1: greatest offer number in an archive, 0 when none parse."""
    ids = _id_strings(spark, d)
    return ids.agg(dedup.max_offer_number(ids, "id_str").alias("max_id"))


# ---------------------------------------------------------------- routing

CORPUS_PROVIDERS = fixed.PROVIDERS + [
    ("corp_blog_net", "corp-blog", ["blog.tionsh.example.net", "blog.ththan.example.net"], False),
    ("corp_net", "corp-net", ["example.net"], False),
    ("corp_net_digest", "corp-net", ["example.net"], True),
    ("corp_com", "corp-com", ["example.com"], False),
    ("corp_mobile", "corp-mobile", ["m.therou.example.com", "m.ththth.example.net"], True),
    ("corp_spam", "corp-spam", ["spam-farm.example.org", "www.cheap-pills.example.com"], False),
]
CORPUS_EXTRACTABLE = fixed.EXTRACTABLE_PROVIDERS + ["corp_blog_net", "corp_net", "corp_com"]


def _pdim(spark):
    return dims.provider_dim(spark, CORPUS_PROVIDERS)


def _sql_values(rows, cols):
    def lit(v):
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, int):
            return str(v)
        return sqlx.q(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) t({', '.join(cols)})"


SQL_PDIM = "pdim AS (SELECT * FROM " + _sql_values(
    [(k, i, folder, dmn.lower(), len(dmn.split(".")), skip)
     for i, (k, folder, ds, skip) in enumerate(CORPUS_PROVIDERS) for dmn in ds],
    ["provider_key", "cfg_pos", "folder", "domain", "n_parts", "skip"]) + ")"
SQL_DMAP = "dmap AS (SELECT domain, arg_max(folder, cfg_pos) AS folder FROM pdim GROUP BY domain)"
SQL_PAGE_DOMAINS = V.SQL_PAGE_MAILS + ",\npm AS (SELECT page_id, from_hdr, " + sqlx.sender_domain("from_hdr") + " AS sender_domain FROM page_mails)"
SQL_SUFFIXES = """cand AS (
  SELECT sender_domain, array_to_string(parts[i:], '.') AS suffix, (len(parts) - i + 1)::INTEGER AS n_parts
  FROM (SELECT DISTINCT sender_domain, string_split(sender_domain, '.') AS parts FROM pm) x, range(1, len(parts) + 1) r(i))"""
SQL_PROVIDER = """prov AS (
  SELECT sender_domain, provider_key, folder, skip, cfg_pos, match_parts FROM (
    SELECT c.sender_domain, d.provider_key, d.folder, d.skip, d.cfg_pos, c.n_parts AS match_parts,
           row_number() OVER (PARTITION BY c.sender_domain ORDER BY c.n_parts DESC, d.cfg_pos) AS rn
    FROM cand c JOIN pdim d ON d.domain = c.suffix) t WHERE rn = 1)"""
SQL_EXPECTED = """expf AS (
  SELECT sender_domain, folder AS expected_folder FROM (
    SELECT c.sender_domain, m.folder, row_number() OVER (PARTITION BY c.sender_domain ORDER BY c.n_parts DESC) AS rn
    FROM cand c JOIN dmap m ON m.domain = c.suffix) t WHERE rn = 1)"""


def _page_domains(spark, d):
    return R.with_sender_domain(V.page_mails(spark, d).select("page_id", "from_hdr"), "from_hdr")


@register("q_sender_domain", V.with_ctes(SQL_PAGE_DOMAINS, body="SELECT page_id, from_hdr, sender_domain FROM pm"))
def q_sender_domain(spark, d):
    """Sender domain of the From header."""
    return _page_domains(spark, d)


@register("q_domain_dim", V.with_ctes(SQL_PDIM, SQL_DMAP, SQL_PAGE_DOMAINS, body="""
SELECT pm.page_id, pm.sender_domain, m.folder AS folder_exact,
       pm.sender_domain IN (SELECT domain FROM pdim WHERE NOT skip) AS active
FROM pm LEFT JOIN dmap m ON m.domain = pm.sender_domain"""))
def q_domain_dim(spark, d):
    """R2 + R3 + O3: exact domain->folder lookup (later config entry wins) and
    membership of the active (non-skipped, distinct) domain list."""
    pdim = _pdim(spark)
    dmap = F.broadcast(dims.domain_folder_map(pdim).withColumnRenamed("domain", "sender_domain")
                       .withColumnRenamed("folder", "folder_exact"))
    act = F.broadcast(dims.active_domains(pdim).withColumnRenamed("domain", "sender_domain")
                      .withColumn("active", F.lit(True)))
    pm = _page_domains(spark, d).select("page_id", "sender_domain")
    out = pm.join(dmap, "sender_domain", "left").join(act, "sender_domain", "left")
    return out.select("page_id", "sender_domain", "folder_exact",
                      F.coalesce("active", F.lit(False)).alias("active"))


@register("q_suffix_route", V.with_ctes(SQL_PDIM, SQL_DMAP, SQL_PAGE_DOMAINS, SQL_SUFFIXES, SQL_EXPECTED, body="""
SELECT pm.page_id, pm.sender_domain, e.expected_folder FROM pm LEFT JOIN expf e USING (sender_domain)"""))
def q_suffix_route(spark, d):
    """Expected folder from the longest configured domain suffix."""
    pm = _page_domains(spark, d).select("page_id", "sender_domain")
    return R.expected_folder(pm, dims.domain_folder_map(_pdim(spark)))


@register("q_provider_detect", V.with_ctes(SQL_PDIM, SQL_PAGE_DOMAINS, SQL_SUFFIXES, SQL_PROVIDER, body=f"""
SELECT pm.page_id, pm.sender_domain, p.provider_key, p.match_parts,
       coalesce(CASE p.provider_key {' '.join(f"WHEN {sqlx.q(k)} THEN {sqlx.q(v)}" for k, v in fixed.SOURCE_DISPLAY.items())} END,
                p.provider_key) AS "Source"
FROM pm LEFT JOIN prov p USING (sender_domain)"""))
def q_provider_detect(spark, d):
    """J2 + T11: most specific provider (config order breaks ties) and its display name."""
    pm = _page_domains(spark, d).select("page_id", "sender_domain")
    routed = R.detect_provider(pm, _pdim(spark))
    return routed.select("page_id", "sender_domain", "provider_key", "match_parts",
                         T.source_display(F.col("provider_key")).alias("Source"))


SQL_ACTUAL_FOLDER = "'corp-' || regexp_extract(pm.sender_domain, '([a-z]+)$', 1)"


@register("q_folder_audit", V.with_ctes(SQL_PDIM, SQL_DMAP, SQL_PAGE_DOMAINS, SQL_SUFFIXES, SQL_EXPECTED, body=f"""
SELECT verdict, count(*) AS n_files FROM (
  SELECT CASE WHEN e.expected_folder IS NULL THEN 'unknown'
              WHEN e.expected_folder = {SQL_ACTUAL_FOLDER} THEN 'ok' ELSE 'misplaced' END AS verdict
  FROM pm LEFT JOIN expf e USING (sender_domain)) t GROUP BY verdict"""))
def q_folder_audit(spark, d):
    """Files per verdict; the folder a page sits in is named after its top-level domain."""
    pm = _page_domains(spark, d).select("page_id", "sender_domain")
    pm = pm.withColumn("folder", F.concat(F.lit("corp-"), F.regexp_extract("sender_domain", "([a-z]+)$", 1)))
    _, summary = R.folder_audit(pm, dims.domain_folder_map(_pdim(spark)))
    return summary


@register("q_dispatch", V.with_ctes(SQL_PDIM, SQL_PAGE_DOMAINS, SQL_SUFFIXES, SQL_PROVIDER, body=f"""
SELECT page_id, provider_key, dispatch_reason,
       CASE WHEN dispatch_reason IN ('missing_file', 'unknown_provider') THEN 'ERREUR'
            WHEN dispatch_reason IS NOT NULL THEN 'IGNORE' END AS dispatch_status
FROM (SELECT pm.page_id, p.provider_key,
             CASE WHEN pg.html IS NULL OR pg.html = '' THEN 'missing_file'
                  WHEN p.provider_key IS NULL THEN 'unknown_provider'
                  WHEN p.skip THEN 'skip'
                  WHEN NOT list_contains([{', '.join(sqlx.q(k) for k in CORPUS_EXTRACTABLE)}], p.provider_key) THEN 'no_extractor'
             END AS dispatch_reason
      FROM pm LEFT JOIN prov p USING (sender_domain) JOIN pages pg ON pg.page_id = pm.page_id) t"""))
def q_dispatch(spark, d):
    """ERREUR (missing file / unknown provider), IGNORE (skip / no job), else to extract."""
    pm = R.with_sender_domain(V.page_mails(spark, d).select("page_id", "from_hdr", "html"), "from_hdr")
    routed = R.detect_provider(pm, _pdim(spark))
    present = F.col("html").isNotNull() & (F.col("html") != "")
    out = R.dispatch(routed, CORPUS_EXTRACTABLE, present)
    return out.select("page_id", "provider_key", "dispatch_reason", "dispatch_status")


# ---------------------------------------------------------------- mail ingest, ledger, index
#
# Over ``ev_files`` (events as landed mail files).  The run day D is the last
# day present; the ledger "before the run" holds the last file per message
# fetched before D; the files of day D are this run's new files.

_RUN_TIMES = memo()


def _run_time(spark, d):
    """Scalar: the latest event time (one value to the driver), read once per
    run and data folder."""
    if d not in _RUN_TIMES:
        _RUN_TIMES[d] = V.table(spark, d, "events").agg(F.max("ts").alias("m")).first()["m"]
    return _RUN_TIMES[d]


def _run_day(spark, d) -> str:
    """The last day present."""
    return _run_time(spark, d).strftime("%Y-%m-%d")


def _ev_ledger(files):
    return LG.latest_per_message(files.withColumn("indexed_at", F.col("fetched_at")), "event_id")


SQL_RUN = """run AS (SELECT date_trunc('day', max(ts)) AS d, max(ts) AS t FROM events)"""
SQL_LEDGER_ALL = """ledger_all AS (
  SELECT message_id, arg_max_null(gmail_id, event_id) AS gmail_id, arg_max_null(fichier, event_id) AS fichier,
         arg_max_null(date_email, event_id) AS date_email, arg_max_null(fetched_at, event_id) AS fetched_at,
         arg_max_null(fetched_at, event_id) AS indexed_at, arg_max_null(statut_extraction, event_id) AS statut_extraction
  FROM ev_files GROUP BY message_id)"""
SQL_LEDGER_OLD = SQL_LEDGER_ALL.replace("ledger_all AS", "ledger_old AS").replace(
    "FROM ev_files GROUP BY", "FROM ev_files WHERE ts < (SELECT d FROM run) GROUP BY")
SQL_NEW_FILES = """new_files AS (SELECT * FROM ev_files WHERE ts >= (SELECT d FROM run))"""


def _paris_sql(ts: str) -> str:
    return f"timezone('{fixed.LOCAL_TZ}', timezone('UTC', {ts}))"


def _offset_sql(ts: str) -> str:
    mins = f"((epoch({_paris_sql(ts)}) - epoch({ts})) / 60)::INTEGER"
    return (f"(CASE WHEN {mins} < 0 THEN '-' ELSE '+' END || lpad((abs({mins}) // 60)::VARCHAR, 2, '0') "
            f"|| lpad((abs({mins}) % 60)::VARCHAR, 2, '0'))")


OFFSET_OF_EVENT = {"click": 2, "error": -5}


def _sql_offset_hours():
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in OFFSET_OF_EVENT.items())
    return f"(CASE event_type {whens} ELSE 0 END)"


@register("q_header_dates", f"""
SELECT event_id, date_raw, strftime(timezone('UTC', p), '%Y-%m-%d %H:%M:%S') AS date_utc,
       strftime({_paris_sql("timezone('UTC', p)")}, '%Y-%m-%dT%H:%M:%S') || {_offset_sql("timezone('UTC', p)")} AS date_email,
       strftime({_paris_sql("timezone('UTC', p)")}, '%Y%m%d-%H%M') AS name_prefix
FROM (SELECT event_id, date_raw, strptime(regexp_replace(date_raw, '^[A-Za-z]{{3}}, ', ''), '%d %b %Y %H:%M:%S %z') AS p
      FROM (SELECT event_id, strftime(ts + to_hours({_sql_offset_hours()}), '%a, %d %b %Y %H:%M:%S') || ' ' ||
                   CASE WHEN {_sql_offset_hours()} < 0 THEN '-' ELSE '+' END || lpad(abs({_sql_offset_hours()})::VARCHAR, 2, '0') || '00' AS date_raw
            FROM events) r) t""")
def q_header_dates(spark, d):
    """S3 + R11 prefix: Date headers with sender offsets parsed back to instants,
    then shown in the mailbox zone (ledger date form and file-name prefix)."""
    e = V.table(spark, d, "events")
    hours = F.lit(0)
    for k, v in OFFSET_OF_EVENT.items():
        hours = F.when(F.col("event_type") == k, F.lit(v)).otherwise(hours)
    shifted = F.col("ts") + F.make_interval(hours=hours)
    off = F.concat(F.when(hours < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.lpad(F.abs(hours).cast("string"), 2, "0"), F.lit("00"))
    raw = F.concat(F.date_format(shifted, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" "), off)
    m = e.select("event_id", raw.alias("date_raw"))
    ts = M.parse_mail_date(F.col("date_raw"))
    return m.select("event_id", "date_raw", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("date_utc"),
                    M.local_iso(ts).alias("date_email"), M.name_prefix(ts).alias("name_prefix"))


@register("q_low_watermark", V.with_ctes(V.SQL_EV_FILES, SQL_LEDGER_ALL, body=f"""
SELECT count(*) FILTER (WHERE real) AS n_real, max(fetched_at) FILTER (WHERE real) AS last_fetch,
       strftime(strptime(max(fetched_at) FILTER (WHERE real), '%Y-%m-%dT%H:%M:%SZ') - INTERVAL {fixed.OVERLAP_MARGIN_HOURS} HOUR, '%Y/%m/%d') AS after_date
FROM (SELECT *, coalesce(gmail_id, '') NOT IN ('before_gmail_api', 'manual') AND coalesce(fetched_at, '') <> '' AS real
      FROM ledger_all) t"""))
def q_low_watermark(spark, d):
    """Incremental start date from the ledger (sentinel source ids ignored)."""
    return LG.low_watermark(_ev_ledger(V.ev_files(spark, d)))


@register("q_delta_partition", V.with_ctes(V.SQL_EV_FILES, SQL_RUN, body="""
SELECT event_id, fichier, strftime(ts, '%Y%m%d') AS run_date FROM ev_files
WHERE ts >= (SELECT d FROM run) AND ts < (SELECT d FROM run) + INTERVAL 1 DAY"""))
def q_delta_partition(spark, d):
    """The run day's delta only (a day-range predicate pushed to the scan)."""
    day = _run_day(spark, d)
    lo = F.lit(day).cast("timestamp_ntz")
    e = V.ev_files(spark, d).where((F.col("ts") >= lo) & (F.col("ts") < lo + F.expr("INTERVAL 1 DAY")))
    return e.select("event_id", "fichier", F.date_format("ts", "yyyyMMdd").alias("run_date"))


@register("q_catchup", V.with_ctes(V.SQL_EV_FILES, SQL_RUN, SQL_LEDGER_ALL, body="""
SELECT message_id, statut_extraction FROM ledger_all
WHERE substr(fetched_at, 1, 10) = strftime((SELECT d FROM run), '%Y-%m-%d')
  AND statut_extraction IS NOT NULL AND statut_extraction <> 'PENDING'"""))
def q_catchup(spark, d):
    """Entries fetched on the run day that already left PENDING."""
    day = _run_day(spark, d)
    led = _ev_ledger(V.ev_files(spark, d))
    return led.where((F.substring("fetched_at", 1, 10) == day) & F.col("statut_extraction").isNotNull()
                     & (F.col("statut_extraction") != "PENDING")).select("message_id", "statut_extraction")


@register("q_pending", V.with_ctes(V.SQL_EV_FILES, SQL_LEDGER_ALL, body="""
SELECT message_id, date_email, row_number() OVER (ORDER BY date_email, message_id)::BIGINT AS pending_rank
FROM ledger_all WHERE coalesce(statut_extraction, 'PENDING') = 'PENDING'"""))
def q_pending(spark, d):
    """R8 + O1: PENDING entries (missing status counts) numbered in
    (date_email string, message_id) order without a single-partition sort."""
    led = _ev_ledger(V.ev_files(spark, d)).where(R.is_pending(F.col("statut_extraction")))
    ranked = dedup.assign_ordered_ids(led.select("message_id", "date_email"), ["date_email", "message_id"],
                                      out_col="pending_rank")
    return ranked.select("message_id", "date_email", "pending_rank")


@register("q_legacy_ledger", V.with_ctes(V.SQL_EV_FILES, body="""
SELECT message_id, 'before_gmail_api' AS gmail_id, arg_max_null(fichier, event_id) AS fichier,
       arg_max_null(date_email, event_id) AS date_email, arg_max_null(fetched_at, event_id) AS fetched_at,
       arg_max_null(fetched_at, event_id) AS indexed_at,
       arg_max_null(coalesce(nullif(coalesce(statut_extraction, ''), ''), 'PENDING'), event_id) AS statut_extraction
FROM ev_files GROUP BY message_id"""))
def q_legacy_ledger(spark, d):
    """Legacy index rows converted to ledger entries (last row per id wins)."""
    f = V.ev_files(spark, d)
    index = f.select(F.col("message_id").alias("Message-ID"), F.col("fichier").alias("Fichier"),
                     F.col("date_email").alias("Date_email"), F.col("fetched_at").alias("Date_indexation"),
                     F.coalesce("statut_extraction", F.lit("")).alias("Statut_extraction"), "event_id")
    return LG.legacy_index_to_ledger(index, "event_id")


SQL_FILE_ACTIONS = """acts AS (
  SELECT f.*, o.fichier AS known_path,
         CASE WHEN o.fichier IS NOT NULL AND o.fichier <> f.fichier THEN 'duplicate'
              WHEN o.fichier IS NULL AND string_split(f.fichier, '/') <> min(string_split(f.fichier, '/')) OVER (PARTITION BY f.message_id) THEN 'duplicate'
              WHEN regexp_matches(f.file_name, '^[0-9]{8}-[0-9]{4}-') THEN 'reindex' ELSE 'rename' END AS action
  FROM new_files f LEFT JOIN ledger_old o USING (message_id))"""


def _file_actions(spark, d):
    """W3 + R10 over this run's files against the ledger before the run."""
    day = _run_day(spark, d)
    files = V.ev_files(spark, d)
    lo = F.lit(day).cast("timestamp_ntz")
    old = _ev_ledger(files.where(F.col("ts") < lo)).select("message_id", F.col("fichier").alias("known_path"))
    new = files.where(F.col("ts") >= lo).withColumn("_path_key", F.split("fichier", "/"))
    j = new.join(old, "message_id", "left")
    j = dedup.first_per_key(j, ["message_id"], "_path_key", out_col="_first_path")
    dup = F.when(F.col("known_path").isNotNull(), F.col("known_path") != F.col("fichier")) \
        .otherwise(~F.col("_first_path"))
    action = F.when(dup, F.lit("duplicate")).otherwise(
        R.file_action(F.lit(None).cast("string"), F.col("fichier"), F.col("file_name")))
    return j.withColumn("action", action).drop("_path_key", "_first_path")


@register("q_message_dedup", V.with_ctes(V.SQL_EV_FILES, SQL_RUN, SQL_LEDGER_OLD, SQL_NEW_FILES, SQL_FILE_ACTIONS, body="""
SELECT fichier, message_id, action = 'duplicate' AS is_duplicate,
       CASE WHEN action = 'duplicate' THEN '_duplicates/' || file_name END AS quarantine_path
FROM acts"""))
def q_message_dedup(spark, d):
    """W3 + R13: a Message-ID known under another file, or a later path of
    the same new Message-ID, goes to quarantine."""
    a = _file_actions(spark, d)
    dup = F.col("action") == "duplicate"
    return a.select("fichier", "message_id", dup.alias("is_duplicate"),
                    F.when(dup, F.concat(F.lit("_duplicates/"), F.col("file_name"))).alias("quarantine_path"))


@register("q_file_action", V.with_ctes(V.SQL_EV_FILES, SQL_RUN, SQL_LEDGER_OLD, SQL_NEW_FILES, SQL_FILE_ACTIONS,
                                       body="SELECT fichier, message_id, action FROM acts"))
def q_file_action(spark, d):
    """Duplicate / reindex / rename per file of the run."""
    return _file_actions(spark, d).select("fichier", "message_id", "action")


@register("q_index_summary", V.with_ctes(V.SQL_EV_FILES, SQL_RUN, SQL_LEDGER_OLD, SQL_NEW_FILES, SQL_FILE_ACTIONS,
                                         body="SELECT action, count(*) AS n_files FROM acts GROUP BY action"))
def q_index_summary(spark, d):
    """Files per index action."""
    return _file_actions(spark, d).groupBy("action").agg(F.count(F.lit(1)).alias("n_files"))


SQL_CANON = f"""renames AS (
  SELECT fichier, folder, strftime({_paris_sql('ts')}, '%Y%m%d-%H%M') || '-' || regexp_replace(file_name, '\\.eml$', '') AS base,
         string_split(fichier, '/') AS k FROM acts WHERE action = 'rename'),
taken AS (
  SELECT folder, base, list(DISTINCT n) AS taken FROM (
    SELECT folder, regexp_replace(file_name, '\\.eml$', '') AS base, 1 AS n FROM ev_files
    UNION ALL
    SELECT folder, regexp_extract(file_name, '^(.*)_([0-9]+)\\.eml$', 1), CAST(regexp_extract(file_name, '^(.*)_([0-9]+)\\.eml$', 2) AS INTEGER)
    FROM ev_files WHERE regexp_matches(file_name, '_[0-9]+\\.eml$')) t GROUP BY folder, base),
ranked AS (SELECT r.*, row_number() OVER (PARTITION BY r.folder, r.base ORDER BY r.k) AS rk, coalesce(t.taken, []) AS taken
           FROM renames r LEFT JOIN taken t USING (folder, base))"""


@register("q_canonical_name", V.with_ctes(V.SQL_EV_FILES, SQL_RUN, SQL_LEDGER_OLD, SQL_NEW_FILES, SQL_FILE_ACTIONS, SQL_CANON, body="""
SELECT fichier, folder || '/' || base || CASE WHEN n > 1 THEN '_' || n::VARCHAR ELSE '' END || '.eml' AS new_name
FROM (SELECT fichier, folder, base,
             list_filter(range(1, rk + len(taken) + 1), lambda x: NOT list_contains(taken, x))[rk] AS n FROM ranked) t"""))
def q_canonical_name(spark, d):
    """``yyyyMMdd-HHmm-<stem>[_n].eml`` in local time; colliding targets
    take the next free ``_n`` (from 2) in path order, skipping names already
    present in the folder."""
    a = _file_actions(spark, d).where(F.col("action") == "rename")
    ts = F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC")
    base = F.concat(M.name_prefix(ts), F.lit("-"), F.regexp_replace("file_name", r"\.eml$", ""))
    ren = a.select("fichier", "folder", base.alias("base"), F.col("fichier").alias("path"))
    existing = V.ev_files(spark, d).select("folder", F.col("file_name").alias("name"))
    out = R.canonical_names(ren, existing)
    return out.select("fichier", F.concat(F.col("folder"), F.lit("/"), F.col("new_name")).alias("new_name"))


@register("q_ledger_upsert", V.with_ctes(V.SQL_EV_FILES, SQL_RUN, SQL_LEDGER_OLD, SQL_NEW_FILES, SQL_FILE_ACTIONS, body=f"""
SELECT coalesce(n.message_id, o.message_id) AS message_id,
       CASE WHEN n.message_id IS NOT NULL THEN coalesce(o.gmail_id, 'manual') ELSE o.gmail_id END AS gmail_id,
       CASE WHEN n.message_id IS NOT NULL THEN n.fichier ELSE o.fichier END AS fichier,
       CASE WHEN n.message_id IS NOT NULL THEN n.date_email ELSE o.date_email END AS date_email,
       CASE WHEN n.message_id IS NOT NULL THEN coalesce(o.fetched_at, (SELECT strftime(t, '%Y-%m-%dT%H:%M:%SZ') FROM run)) ELSE o.fetched_at END AS fetched_at,
       CASE WHEN n.message_id IS NOT NULL THEN (SELECT strftime(t, '%Y-%m-%dT%H:%M:%SZ') FROM run) ELSE o.indexed_at END AS indexed_at,
       CASE WHEN n.message_id IS NOT NULL THEN coalesce(o.statut_extraction, 'PENDING') ELSE o.statut_extraction END AS statut_extraction
FROM ledger_old o FULL OUTER JOIN (
  SELECT message_id,
         CASE WHEN action = 'rename' THEN folder || '/' || strftime({_paris_sql('ts')}, '%Y%m%d-%H%M') || '-' || regexp_replace(file_name, '\\.eml$', '') || '.eml'
              ELSE fichier END AS fichier,
         strftime({_paris_sql('ts')}, '%Y-%m-%dT%H:%M:%S') || {_offset_sql('ts')} AS date_email
  FROM acts WHERE action <> 'duplicate') n USING (message_id)"""))
def q_ledger_upsert(spark, d):
    """R14 + S6: index results merged into the ledger (full outer join)."""
    files = V.ev_files(spark, d)
    day = _run_day(spark, d)
    run_t = _run_time(spark, d).strftime("%Y-%m-%dT%H:%M:%SZ")
    old = _ev_ledger(files.where(F.col("ts") < F.lit(day).cast("timestamp_ntz")))
    a = _file_actions(spark, d).where(F.col("action") != "duplicate")
    ts = F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC")
    renamed = F.concat(F.col("folder"), F.lit("/"), M.name_prefix(ts), F.lit("-"),
                       F.regexp_replace("file_name", r"\.eml$", ""), F.lit(".eml"))
    idx = a.select("message_id",
                   F.when(F.col("action") == "rename", renamed).otherwise(F.col("fichier")).alias("fichier"),
                   M.local_iso(ts).alias("date_email"))
    return LG.upsert_index(old.select(*LG.LEDGER_COLUMNS), idx, F.lit(run_t))


def _workspace(spark) -> str:
    """A folder of its own in the shared folder, for the tables that a query commits to."""
    return f"{ensure_checkpoint_dir(spark)}/queries/{uuid.uuid4().hex}"


@register("q_ledger_commits", V.with_ctes(V.SQL_EV_FILES, SQL_RUN, SQL_LEDGER_OLD, SQL_NEW_FILES, SQL_FILE_ACTIONS, body="""
SELECT coalesce(n.message_id, o.message_id) AS message_id,
       CASE WHEN n.message_id IS NOT NULL THEN coalesce(o.gmail_id, 'manual') ELSE o.gmail_id END AS gmail_id,
       CASE WHEN n.message_id IS NOT NULL THEN n.fichier ELSE o.fichier END AS fichier,
       CASE WHEN n.message_id IS NOT NULL THEN 'OK' ELSE o.statut_extraction END AS statut_extraction
FROM ledger_old o FULL OUTER JOIN (SELECT message_id, fichier FROM acts WHERE action <> 'duplicate') n USING (message_id)"""))
def q_ledger_commits(spark, d):
    """S6 + R14: the stored ledger after three commits: the old entries, a run's index results, its statuses."""
    day = _run_day(spark, d)
    ledger = LG.ledger_table(spark, f"{_workspace(spark)}/ledger")
    old = _ev_ledger(V.ev_files(spark, d).where(F.col("ts") < F.lit(day).cast("timestamp_ntz")))
    ledger.commit("old", lambda _: old, blind=True)
    new = materialize(_file_actions(spark, d).where(F.col("action") != "duplicate").select(
        "message_id", "fichier", F.lit("").alias("date_email")))
    LG.index_messages(ledger, "index", new, F.lit(""))
    LG.record_statuses(ledger, "status", new.select("message_id", F.lit("OK").alias("statut_extraction")))
    return ledger.read().select("message_id", "gmail_id", "fichier", "statut_extraction")


@register("q_key_index", V.with_ctes(SQL_KEYED, body="""
SELECT cle AS "Cle_dedup", arg_min("ID", ord) AS first_id, arg_max("ID", ord) AS last_id, count(*) AS n
FROM keyed WHERE archived AND coalesce(cle, '') <> '' AND cle IN (SELECT cle FROM keyed WHERE NOT archived) GROUP BY cle"""))
def q_key_index(spark, d):
    """J6 + A3 + A8: the archive's rows enter the persisted key index in two commits; the batch's keys are looked up."""
    archive = Archive(spark, _workspace(spark))
    k = _keyed(spark, d)
    for part in (0, 1):
        archive.add_keys(f"run {part}", k.where(F.col("archived") & (F.col("ord") % 2 == part)))
    asked = k.where(~F.col("archived")).select("Cle_dedup").distinct()
    return archive.keys.read(asked).join(asked, "Cle_dedup", "left_semi").select("Cle_dedup", "first_id", "last_id", "n")


@register("q_publish_parts", """
WITH runs AS (SELECT coalesce(lang, '') AS run, count(*) AS n FROM documents GROUP BY 1)
SELECT run, n AS "rows", sum(n) OVER (ORDER BY run)::BIGINT - n + 1 AS first_id, sum(n) OVER (ORDER BY run)::BIGINT AS last_id,
       0::BIGINT AS published_before FROM runs""")
def q_publish_parts(spark, d):
    """A1 + A2 + P3: a run for each language reserves the IDs of its offers in turn; one batch claims all partitions."""
    archive = Archive(spark, _workspace(spark))
    docs = V.table(spark, d, "documents").groupBy(F.coalesce("lang", F.lit("")).alias("run")).agg(F.count(F.lit(1)).alias("n"))
    for r in docs.orderBy("run").collect():  # one row per language
        archive.reserve(r["run"], r["n"])
    _, before = archive.claim("b1", [])
    return archive.parts.read().where("kind = 'offers' and published_by = 'b1'").select(
        "run", "rows", "first_id", "last_id", F.lit(before).cast("bigint").alias("published_before"))


# ---------------------------------------------------------------- offers, status, publish
#
# ``conversations`` as extraction output: a conversation is a mail, a turn is
# a raw offer (title = text, company = role); system turns have an empty
# title and are rejected.

def conv_raw(spark, d):
    c = V.table(spark, d, "conversations", text_work=True)
    return c.select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("message_id"),
        F.col("turn").alias("offer_pos"),
        F.lit("conversations").alias("provider_key"),
        F.lit("").alias("date_email"),
        F.when(F.col("role") == "system", F.lit("")).otherwise(F.col("text")).alias("titre"),
        F.col("role").alias("entreprise"),
        *[F.lit("").alias(c) for c in ["ville", "dept", "type_contrat", "salaire_min", "salaire_max", "url", "notes"]],
        F.lit("vide").alias("url_qualite"))


def conv_rows(spark, d):
    return EN.offer_rows(conv_raw(spark, d), keywords=CORPUS_STACK, blacklist=CORPUS_BLACKLIST)


def sql_offer_rows(raw: str, prefix: str) -> str:
    """SQL twin of ``enrich.offer_rows`` over a raw-offers CTE named ``raw``."""
    src = " ".join(f"WHEN {sqlx.q(k)} THEN {sqlx.q(v)}" for k, v in fixed.SOURCE_DISPLAY.items())
    return f"""{prefix}_valid AS (SELECT *, row_number() OVER (ORDER BY date_email, message_id, offer_pos) AS seq FROM {raw} WHERE coalesce(titre, '') <> ''),
{prefix}_keyed AS (SELECT *, printf('E%06d', seq) AS "ID", {sqlx.dedup_key('entreprise', 'ville', 'titre')} AS cle FROM {prefix}_valid),
{prefix}_first AS (SELECT cle, arg_min("ID", seq) AS first_id FROM {prefix}_keyed GROUP BY cle),
{prefix}_bl AS (SELECT k.*, CASE WHEN k."ID" <> f.first_id THEN f.first_id ELSE '' END AS doublon,
                   {sqlx.blacklist_term('titre', CORPUS_BLACKLIST)} AS bl
            FROM {prefix}_keyed k JOIN {prefix}_first f USING (cle)),
{prefix}_rows AS (
  SELECT "ID", 'FALSE' AS "Traite", substr(date_email, 1, 10) AS "Date_decouverte",
         coalesce(CASE provider_key {src} END, provider_key) AS "Source",
         titre AS "Titre", entreprise AS "Entreprise", cle AS "Cle_dedup", doublon AS "Doublon_ID", ville AS "Ville",
         '' AS "Dept", '' AS "Type_contrat", '' AS "Salaire_min", '' AS "Salaire_max", url AS "URL",
         url_qualite AS "URL_qualite", '' AS "URL_redirect", {sqlx.stack_tags("titre || ' ' || notes", CORPUS_STACK)} AS "Stack",
         coalesce('{fixed.BLACKLIST_REASON_PREFIX}' || bl, '') AS "Raison_exclusion", '' AS "Date_candidature",
         concat_ws(' | ', nullif(notes, ''), '{fixed.BLACKLIST_NOTE_PREFIX}' || bl) AS "Notes", message_id AS "Message_ID", seq
  FROM {prefix}_bl)"""


SQL_CONV = """conv_raw AS (
  SELECT 'c' || conv_id::VARCHAR AS message_id, turn AS offer_pos, 'conversations' AS provider_key, '' AS date_email,
         CASE WHEN role = 'system' THEN '' ELSE text END AS titre, role AS entreprise, '' AS ville, '' AS notes,
         '' AS url, 'vide' AS url_qualite
  FROM conversations),
""" + sql_offer_rows("conv_raw", "conv") + """,
offer_rows AS (SELECT * FROM conv_rows)"""


SQL_MAIL_STATUS = """mail_status AS (
  SELECT message_id, count(*) FILTER (WHERE titre <> '') AS n_ok, count(*) FILTER (WHERE titre = '') AS n_rejected,
         CASE WHEN count(*) FILTER (WHERE titre = '') = 0 AND count(*) FILTER (WHERE titre <> '') > 0 THEN 'OK' ELSE 'PARTIEL' END AS statut_extraction
  FROM conv_raw GROUP BY message_id)"""
OFFER_COLS_SQL = ", ".join(f'"{c}"' for c in fixed.OFFER_COLUMNS)


@register("q_offer_rows", V.with_ctes(SQL_CONV, body=f"SELECT {OFFER_COLS_SQL} FROM offer_rows"))
def q_offer_rows(spark, d):
    """P1 (+T12, W1, W2, T6-T9): the 21-column offer rows."""
    return conv_rows(spark, d).drop("_seq")


@register("q_csv_delta", V.with_ctes(SQL_CONV, body="SELECT " + ", ".join(
    f"coalesce(\"{c}\", '') AS \"{c}\"" for c in fixed.OFFER_COLUMNS) + " FROM offer_rows"))
def q_csv_delta(spark, d):
    """The offer rows written as a day's delta of two runs (quotes, separators and line ends in cells) and read back."""
    root = f"{_workspace(spark)}/deltas"
    rows = materialize(conv_rows(spark, d).drop("_seq"))
    for part in (0, 1):
        IO.write_dated_delta(rows.where(F.pmod(F.xxhash64("ID"), F.lit(2)) == part), root, "20260101", f"r{part}")
    return IO.read_dated_delta(spark, root, "20260101")


@register("q_rejects", V.with_ctes(SQL_CONV, body="SELECT message_id, offer_pos, 'titre_vide' AS reason FROM conv_raw WHERE titre = ''"))
def q_rejects(spark, d):
    """Offers rejected for an empty title (no ID consumed)."""
    return EN.rejects(conv_raw(spark, d))


@register("q_mail_status", V.with_ctes(SQL_CONV, SQL_MAIL_STATUS, body="SELECT * FROM mail_status"))
def q_mail_status(spark, d):
    """A5: OK / PARTIEL per mail."""
    return EN.mail_status(conv_raw(spark, d))


@register("q_run_stats", V.with_ctes(SQL_CONV, SQL_MAIL_STATUS, body="""
SELECT (SELECT count(*) FILTER (WHERE statut_extraction = 'OK') FROM mail_status) AS fichiers_ok,
       (SELECT count(*) FILTER (WHERE statut_extraction = 'PARTIEL') FROM mail_status) AS fichiers_partiel,
       (SELECT count(*) FILTER (WHERE statut_extraction = 'ERREUR') FROM mail_status) AS erreurs,
       (SELECT count(*) FILTER (WHERE statut_extraction = 'IGNORE') FROM mail_status) AS ignores,
       (SELECT count(*) FROM offer_rows) AS offres_ecrites,
       (SELECT count(*) FILTER (WHERE "Doublon_ID" <> '') FROM offer_rows) AS doublons,
       (SELECT count(*) FILTER (WHERE "Raison_exclusion" <> '') FROM offer_rows) AS blacklistes,
       FALSE AS dry_run"""))
def q_run_stats(spark, d):
    """A4: run counters."""
    raw = conv_raw(spark, d)
    return PB.run_stats(EN.mail_status(raw), conv_rows(spark, d))


@register("q_run_events", V.with_ctes(SQL_CONV, SQL_MAIL_STATUS, body="""
SELECT level, message_id, msg FROM (
  SELECT CASE WHEN statut_extraction = 'OK' THEN 'INFO' ELSE 'WARN' END AS level, message_id,
         CASE WHEN statut_extraction = 'OK' THEN n_ok::VARCHAR || ' offre(s) écrites'
              ELSE n_ok::VARCHAR || ' offre(s) OK, ' || n_rejected::VARCHAR || ' ignorée(s)' END AS msg
  FROM mail_status
  UNION ALL
  SELECT 'WARN', message_id, 'Offre ignorée (titre vide)' FROM conv_raw WHERE titre = ''
  UNION ALL
  SELECT 'INFO', "Message_ID", 'Doublon : ' || "Cle_dedup" || ' → ' || "Doublon_ID" FROM offer_rows WHERE "Doublon_ID" <> '') t"""))
def q_run_events(spark, d):
    """Run log entries as rows (mail outcome, rejected offers, duplicates)."""
    raw = conv_raw(spark, d)
    st = EN.mail_status(raw)
    ok = F.col("statut_extraction") == "OK"
    mails = st.select(F.when(ok, F.lit("INFO")).otherwise(F.lit("WARN")).alias("level"), "message_id",
                      F.when(ok, F.concat(F.col("n_ok").cast("string"), F.lit(" offre(s) écrites")))
                      .otherwise(F.concat(F.col("n_ok").cast("string"), F.lit(" offre(s) OK, "),
                                          F.col("n_rejected").cast("string"), F.lit(" ignorée(s)"))).alias("msg"))
    rej = EN.rejects(raw).select(F.lit("WARN").alias("level"), "message_id",
                                 F.lit("Offre ignorée (titre vide)").alias("msg"))
    dups = conv_rows(spark, d).where(F.col("Doublon_ID") != "").select(
        F.lit("INFO").alias("level"), F.col("Message_ID").alias("message_id"),
        F.concat(F.lit("Doublon : "), F.col("Cle_dedup"), F.lit(" → "), F.col("Doublon_ID")).alias("msg"))
    return mails.unionByName(rej).unionByName(dups)


@register("q_offers_by_mail", V.with_ctes(SQL_CONV, SQL_MAIL_STATUS, body="""
SELECT o."ID", o."Message_ID" AS message_id, s.statut_extraction FROM offer_rows o JOIN mail_status s ON s.message_id = o."Message_ID\""""))
def q_offers_by_mail(spark, d):
    """Offers joined to their mail on Message_ID."""
    st = EN.mail_status(conv_raw(spark, d)).select("message_id", "statut_extraction")
    o = conv_rows(spark, d).select("ID", F.col("Message_ID").alias("message_id"))
    return o.join(st, "message_id")


@register("q_row_flags", V.with_ctes(SQL_CONV, body="""
SELECT "ID", "Doublon_ID" <> '' AS is_duplicate, contains(lower("Notes"), 'blacklist') AS is_blacklisted,
       CASE WHEN contains(lower("Notes"), 'blacklist') THEN 'blacklisted' WHEN "Doublon_ID" <> '' THEN 'duplicate' ELSE 'new' END AS row_flag
FROM offer_rows"""))
def q_row_flags(spark, d):
    """Duplicate / blacklisted flags (blacklisted takes priority)."""
    r = conv_rows(spark, d)
    dup = F.col("Doublon_ID") != ""
    bl = F.lower(F.col("Notes")).contains("blacklist")
    return r.select("ID", dup.alias("is_duplicate"), bl.alias("is_blacklisted"),
                    F.when(bl, F.lit("blacklisted")).when(dup, F.lit("duplicate")).otherwise(F.lit("new")).alias("row_flag"))


@register("q_worklist", V.with_ctes(SQL_CONV, body="""
SELECT "ID", "Date_decouverte", row_number() OVER (ORDER BY "Date_decouverte", CAST(substr("ID", 2) AS BIGINT))::BIGINT AS work_rank
FROM offer_rows WHERE "Raison_exclusion" = ''"""))
def q_worklist(spark, d):
    """Rows still to review (not excluded), by discovery date."""
    r = conv_rows(spark, d).where(F.col("Raison_exclusion") == "").select("ID", "Date_decouverte")
    # by the ID's number: as strings, E1000000 would come before E999999
    r = r.withColumn("_number", T.parse_offer_id_lenient(F.col("ID")))
    return dedup.assign_ordered_ids(r, ["Date_decouverte", "_number"], out_col="work_rank").drop("_number")


SQL_PUB = SQL_CONV + ",\n" + V.SQL_DOC_OFFERS + """,
published AS (SELECT "ID" FROM offer_rows),
last_pub AS (SELECT coalesce(max(CAST(substr("ID", 2) AS BIGINT)), 0) AS last_id FROM published),
delta AS (SELECT "ID", CAST(substr("ID", 2) AS BIGINT) AS id_num FROM doc_offers WHERE CAST(substr("ID", 2) AS BIGINT) > (SELECT last_id FROM last_pub))"""


def _delta(spark, d):
    """Published sheet = the conversation offers; new rows = the document offers."""
    pub = conv_rows(spark, d).select("ID")
    last = pub.agg(PB.max_published(pub).alias("m")).first()["m"]
    return PB.publish_delta(V.doc_offers(spark, d).select("ID", "ord"), last), pub


@register("q_publish_delta", V.with_ctes(SQL_PUB, body="SELECT \"ID\", id_num FROM delta"))
def q_publish_delta(spark, d):
    """P3 + A2: offers with an ID above the last published one."""
    delta, _ = _delta(spark, d)
    return delta.select("ID", "id_num")


@register("q_append_pos", V.with_ctes(SQL_PUB, body="""
SELECT "ID", (SELECT count(*) + 1 FROM published) + row_number() OVER (ORDER BY id_num) AS sheet_row FROM delta"""))
def q_append_pos(spark, d):
    """Sheet rows of the new rows: after the header and the published rows."""
    delta, pub = _delta(spark, d)
    last_row = pub.count() + 1
    return PB.append_positions(delta.select("ID", "id_num"), last_row, "id_num").select("ID", "sheet_row")


@register("q_publish_shape", V.with_ctes(SQL_CONV, body="SELECT " + ", ".join(
    ("CASE WHEN \"Raison_exclusion\" <> '' THEN 'TRUE' ELSE 'FALSE' END AS \"Traite\"" if c == "Traite" else
     f"CASE WHEN \"{c}\" <> '' THEN '''' || \"{c}\" ELSE \"{c}\" END AS \"{c}\"" if c in fixed.FORCE_TEXT_COLUMNS else
     f"coalesce(\"{c}\", '') AS \"{c}\"") for c in fixed.OFFER_COLUMNS) + " FROM offer_rows"))
def q_publish_shape(spark, d):
    """Rows as published (all text, header order)."""
    return PB.publish_shape(conv_rows(spark, d))


@register("q_islands", V.with_ctes(SQL_CONV, body="""
SELECT flag, min(pos)::BIGINT AS range_start, max(pos)::BIGINT AS range_end FROM (
  SELECT flag, pos, pos - row_number() OVER (PARTITION BY flag ORDER BY pos) AS grp FROM (
    SELECT seq + 1 AS pos, CASE WHEN "Raison_exclusion" = '' THEN 'dropdown' ELSE 'clear' END AS flag FROM offer_rows) a) b
GROUP BY flag, grp"""))
def q_islands(spark, d):
    """W4 + W5: contiguous sheet-row ranges without (dropdown) / with (clear) an exclusion reason."""
    r = conv_rows(spark, d).withColumn("pos", F.col("_seq") + 1)
    flag = F.when(F.col("Raison_exclusion") == "", F.lit("dropdown")).otherwise(F.lit("clear"))
    return PB.islands(r, "pos", flag)


SQL_AUDIT = """audit AS (
  SELECT CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS recorded_at,
         CASE WHEN value > 50 THEN strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') END AS acked_at
  FROM events)"""


@register("q_gate", V.with_ctes(SQL_AUDIT, body="""
SELECT count(*) FILTER (WHERE status = 'failed' AND acked_at IS NULL) > 0 AS blocked,
       count(*) FILTER (WHERE status = 'failed' AND acked_at IS NULL) AS n_unacked,
       max(recorded_at) FILTER (WHERE status = 'failed' AND acked_at IS NULL) AS last_failure_at FROM audit"""))
def q_gate(spark, d):
    """Publish attempts (errors = failed, all other events = ok; high value = acknowledged)
    and the resulting gate state."""
    e = V.table(spark, d, "events")
    audit = e.select(F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("ok")).alias("status"),
                     F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("recorded_at"),
                     F.when(F.col("value") > 50, F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"),
                                                               "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("acked_at"))
    return PB.gate_state(audit)


@register("q_resolve_ids", V.with_ctes(V.SQL_EV_FILES, SQL_LEDGER_ALL, body="""
SELECT p.message_id, l.gmail_id, p.pos FROM (
  SELECT message_id, row_number() OVER (ORDER BY date_email, message_id)::BIGINT AS pos
  FROM ledger_all WHERE coalesce(statut_extraction, 'PENDING') = 'PENDING') p
JOIN ledger_all l USING (message_id)
WHERE l.gmail_id IS NOT NULL AND l.gmail_id NOT IN ('before_gmail_api', 'manual')"""))
def q_resolve_ids(spark, d):
    """P9 + J7: the PENDING snapshot (taken before extraction, kept in order)
    resolved to real source ids; sentinel and unknown ids dropped."""
    led = _ev_ledger(V.ev_files(spark, d))
    snap = dedup.assign_ordered_ids(
        led.where(R.is_pending(F.col("statut_extraction"))).select("message_id", "date_email"),
        ["date_email", "message_id"], out_col="pos").select("message_id", "pos")
    return PB.resolve_source_ids(snap, led).select("message_id", "gmail_id", "pos")


@register("q_cleanup_semi", V.with_ctes(V.SQL_EV_FILES, SQL_LEDGER_ALL, V.SQL_MAIL_LIST, body="""
SELECT m.gmail_id, m.gmail_id IN (SELECT gmail_id FROM ledger_all
         WHERE statut_extraction IS NOT NULL AND statut_extraction NOT IN ('PENDING', 'ERREUR')
           AND gmail_id IS NOT NULL AND gmail_id NOT IN ('before_gmail_api', 'manual')) AS to_trash
FROM mail_list m WHERE m.event_type = 'click'"""))
def q_cleanup_semi(spark, d):
    """Labelled messages (clicks) that the ledger confirms processed go to
    trash (semi join); the others are kept (anti join)."""
    led = _ev_ledger(V.ev_files(spark, d))
    labelled = V.mail_list(spark, d).where(F.col("event_type") == "click").select("gmail_id")
    proc = PB.processed_source_ids(led)
    yes = labelled.join(proc, "gmail_id", "left_semi").withColumn("to_trash", F.lit(True))
    no = labelled.join(proc, "gmail_id", "left_anti").withColumn("to_trash", F.lit(False))
    return yes.unionByName(no)


# ---------------------------------------------------------------- geo and parsing
#
# ``part.p_name`` ("red bolt", "small ring", ...) plays the city string; the
# city dimension is the package default extended with corpus entries; the
# geocoder stand-in is a reference table derived from ``part``.

CORPUS_CITIES = fixed.CITY_DEPT + [("hot gear", "21"), ("red widget", "22"), ("blue widget", "23"),
                                   ("small gizmo", "24"), ("smallville", "25")]
_WSQ = sqlx.q(rx.space_class() + "+")


def _sql_cities():
    return "cdimk AS (SELECT pos, lower(city) AS city_key, dept FROM " + _sql_values(
        [(i, c, dd) for i, (c, dd) in enumerate(CORPUS_CITIES)], ["pos", "city", "dept"]) + ")"


SQL_GEO = _sql_cities() + f""",
ck AS (SELECT ville, strip_accents(regexp_replace(lower(ville), {sqlx.q('^' + rx.space_class() + '+|' + rx.space_class() + '+$')}, '', 'g')) AS k
       FROM (SELECT DISTINCT p_name AS ville FROM part WHERE coalesce(p_name, '') <> '') c),
ex AS (SELECT city_key, arg_min(dept, pos) AS dept_exact FROM cdimk GROUP BY city_key),
c1 AS (SELECT ck.ville, ck.k, ex.dept_exact,
              coalesce(string_split_regex(regexp_replace(ck.k, {sqlx.q('^' + rx.space_class() + '+')}, '', 'g'), {_WSQ})[1], '') AS w
       FROM ck LEFT JOIN ex ON ex.city_key = ck.k),
pref AS (SELECT w, arg_min(dept, pos) AS dept_prefix
         FROM (SELECT DISTINCT w FROM c1 WHERE dept_exact IS NULL AND w <> '') x JOIN cdimk ON starts_with(city_key, x.w) GROUP BY w),
gref AS (SELECT p_name AS ville, substr(min(lpad((p_size * 1000)::VARCHAR, 5, '0')), 1, 2) AS dept_geocode FROM part GROUP BY p_name),
res AS (SELECT c1.ville, c1.dept_exact, CASE WHEN c1.dept_exact IS NULL THEN pref.dept_prefix END AS dept_prefix,
               CASE WHEN c1.dept_exact IS NULL AND pref.dept_prefix IS NULL THEN gref.dept_geocode END AS dept_geocode
        FROM c1 LEFT JOIN pref USING (w) LEFT JOIN gref USING (ville))"""


def _geo(spark, d, with_geocode=True):
    part = V.table(spark, d, "part")
    cdim = dims.city_dim(spark, CORPUS_CITIES)
    gref = None
    if with_geocode:
        gref = part.select(F.col("p_name").alias("city"),
                           F.lpad((F.col("p_size") * 1000).cast("string"), 5, "0").alias("postcode"))
    return part, G.resolve_cities(part.select(F.col("p_name").alias("ville")), cdim, gref)


@register("q_city_exact", V.with_ctes(SQL_GEO, body="SELECT ville, dept_exact FROM res"))
def q_city_exact(spark, d):
    """Exact key lookup (distinct cities)."""
    _, res = _geo(spark, d, with_geocode=False)
    return res.select("ville", "dept_exact")


@register("q_city_prefix", V.with_ctes(SQL_GEO, body="SELECT ville, dept_exact, dept_prefix FROM res"))
def q_city_prefix(spark, d):
    """First configured city starting with the first word, when no exact match."""
    _, res = _geo(spark, d, with_geocode=False)
    return res.select("ville", "dept_exact", "dept_prefix")


@register("q_geocode_ref", V.with_ctes(SQL_GEO, body="""
SELECT p.p_partkey, p.p_name AS ville, coalesce(r.dept_exact, r.dept_prefix, r.dept_geocode, '') AS "Dept",
       CASE WHEN r.dept_exact IS NOT NULL THEN 'exact' WHEN r.dept_prefix IS NOT NULL THEN 'prefix'
            WHEN r.dept_geocode IS NOT NULL THEN 'geocode' ELSE 'none' END AS dept_method
FROM part p LEFT JOIN res r ON r.ville = p.p_name"""))
def q_geocode_ref(spark, d):
    """J3 -> J4 -> J5 chain per row, with the method that resolved it."""
    part, res = _geo(spark, d)
    rows = part.select("p_partkey", F.col("p_name").alias("ville"))
    small, _ = sized_broadcast_df(res.drop("_grp_n"))
    j = rows.join(small, "ville", "left")
    return j.select("p_partkey", "ville", F.coalesce("Dept", F.lit("")).alias("Dept"),
                    F.coalesce("dept_method", F.lit("none")).alias("dept_method"))


def sized_broadcast_df(df):
    from alertlake.operators.joins import sized_broadcast
    return sized_broadcast(df)


SQL_PLACES = """places AS (
  SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN lpad(p_size::VARCHAR, 2, '0') || ' - ' || p_name
                                WHEN 'SMALL' THEN p_name || ' (' || lpad(p_size::VARCHAR, 2, '0') || ')'
                                WHEN 'MEDIUM' THEN lpad((p_size * 1000)::VARCHAR, 5, '0') || ' ' || p_name
                                WHEN 'PROMO' THEN p_name || ' (Hybride)' ELSE p_name END AS place FROM part)"""


def _sql_place():
    w = rx.space_class()
    trim = lambda x: f"regexp_replace({x}, {sqlx.q('^' + w + '+|' + w + '+$')}, '', 'g')"
    p = trim("place")
    m1, m2, m3 = (f"regexp_matches({p}, {sqlx.q(r)})" for r in (G.LOC_DEPT_CITY, G.LOC_CITY_DEPT, G.LOC_POSTCODE_CITY))
    ville = (f"CASE WHEN {m1} THEN {trim(f'regexp_extract({p}, {sqlx.q(G.LOC_DEPT_CITY)}, 2)')} "
             f"WHEN {m2} THEN {trim(f'regexp_extract({p}, {sqlx.q(G.LOC_CITY_DEPT)}, 1)')} "
             f"WHEN {m3} THEN {trim(f'regexp_extract({p}, {sqlx.q(G.LOC_POSTCODE_CITY)}, 2)')} "
             f"ELSE {trim(f'regexp_replace({p}, {sqlx.q(G.LOC_MODE)}, {chr(39)}{chr(39)}, {chr(39)}g{chr(39)})')} END")
    dept = (f"CASE WHEN {m1} THEN regexp_extract({p}, {sqlx.q(G.LOC_DEPT_CITY)}, 1) "
            f"WHEN {m2} THEN regexp_extract({p}, {sqlx.q(G.LOC_CITY_DEPT)}, 2) "
            f"WHEN {m3} THEN substr(regexp_extract({p}, {sqlx.q(G.LOC_POSTCODE_CITY)}, 1), 1, 2) ELSE '' END")
    return f"SELECT p_partkey, place, {ville} AS ville, {dept} AS dept FROM places"


@register("q_place_parse", V.with_ctes(SQL_PLACES, body=_sql_place()))
def q_place_parse(spark, d):
    """The four place layouts of the templates."""
    p = V.table(spark, d, "part")
    size2 = F.lpad(F.col("p_size").cast("string"), 2, "0")
    place = (F.when(F.col("p_type") == "ECONOMY", F.concat(size2, F.lit(" - "), F.col("p_name")))
             .when(F.col("p_type") == "SMALL", F.concat(F.col("p_name"), F.lit(" ("), size2, F.lit(")")))
             .when(F.col("p_type") == "MEDIUM", F.concat(F.lpad((F.col("p_size") * 1000).cast("string"), 5, "0"),
                                                         F.lit(" "), F.col("p_name")))
             .when(F.col("p_type") == "PROMO", F.concat(F.col("p_name"), F.lit(" (Hybride)")))
             .otherwise(F.col("p_name")))
    p = p.select("p_partkey", place.alias("place"))
    ville, dept = G.parse_place(F.col("place"))
    return p.select("p_partkey", "place", ville.alias("ville"), dept.alias("dept"))


SQL_SALARY_BLOCKS = """blocks AS (
  SELECT o_orderkey, ((o_custkey * 10 + 20000) // 1000)::VARCHAR || ' ' || lpad(((o_custkey * 10 + 20000) % 1000)::VARCHAR, 3, '0')
         || ' <span itemprop=''salaryCurrency''>€</span> à '
         || ((o_custkey * 10 + 25000) // 1000)::VARCHAR || ' ' || lpad(((o_custkey * 10 + 25000) % 1000)::VARCHAR, 3, '0')
         || ' <span itemprop=''salaryCurrency''>€</span> '
         || CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'par mois' ELSE 'par an' END AS block
  FROM orders)"""


def _sql_salary():
    r = sqlx.q(G.SALARY_RE)
    period = f"regexp_extract(block, {r}, 3)"
    fac = f"(CASE WHEN {period} = 'par mois' THEN 12 ELSE 1 END)"
    amt = lambda g: f"(TRY_CAST(regexp_replace(regexp_extract(block, {r}, {g}), {sqlx.q(rx.space_class())}, '', 'g') AS BIGINT) * {fac})"
    ok = f"({period} <> '' AND {amt(1)} IS NOT NULL AND {amt(2)} IS NOT NULL)"
    return (f"SELECT o_orderkey, CASE WHEN {ok} THEN {amt(1)}::VARCHAR ELSE '' END AS salaire_min, "
            f"CASE WHEN {ok} THEN {amt(2)}::VARCHAR ELSE '' END AS salaire_max FROM blocks")


@register("q_salary", V.with_ctes(SQL_SALARY_BLOCKS, body=_sql_salary()))
def q_salary(spark, d):
    """Salary range text -> annual integers (monthly x12)."""
    o = V.table(spark, d, "orders")

    def grouped(n):
        return F.concat((n / 1000).cast("bigint").cast("string"), F.lit(" "),
                        F.lpad((n % 1000).cast("string"), 3, "0"))
    a = F.col("o_custkey") * 10 + 20000
    b = F.col("o_custkey") * 10 + 25000
    cur = " <span itemprop='salaryCurrency'>€</span> "
    period = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("par mois")).otherwise(F.lit("par an"))
    block = F.concat(grouped(a), F.lit(cur + "à "), grouped(b), F.lit(cur), period)
    smin, smax = G.parse_salary(block)
    return o.select("o_orderkey", smin.alias("salaire_min"), smax.alias("salaire_max"))


# ---------------------------------------------------------------- fetch flow

ACTIVE_DOMAINS = sorted({dm.lower() for _, _, ds, skip in CORPUS_PROVIDERS if not skip for dm in ds})
SQL_ACTIVE = "active AS (SELECT * FROM " + _sql_values([(x,) for x in ACTIVE_DOMAINS], ["domain"]) + ")"
SQL_LISTING = f"""listing AS (
  SELECT m.*, {sqlx.sender_domain('m.from_hdr')} AS sender_domain FROM mail_list m
  WHERE m.date_ts >= (SELECT strptime(strftime(strptime(max(fetched_at) FILTER (WHERE coalesce(gmail_id, '') NOT IN ('before_gmail_api', 'manual') AND coalesce(fetched_at, '') <> ''), '%Y-%m-%dT%H:%M:%SZ') - INTERVAL {fixed.OVERLAP_MARGIN_HOURS} HOUR, '%Y/%m/%d'), '%Y/%m/%d') FROM ledger_old)
    AND EXISTS (SELECT 1 FROM active a WHERE {sqlx.sender_domain('m.from_hdr')} = a.domain OR ends_with({sqlx.sender_domain('m.from_hdr')}, '.' || a.domain)))"""


def _listing(spark, d):
    """R4 + R5: messages from active sender domains since the low watermark
    of the ledger before the run (one date to the driver, pushed as a literal)."""
    day = _run_day(spark, d)
    old = _ev_ledger(V.ev_files(spark, d).where(F.col("ts") < F.lit(day).cast("timestamp_ntz")))
    after = LG.low_watermark(old).first()["after_date"]
    return FE.select_listing(V.mail_list(spark, d), ACTIVE_DOMAINS, after), old


@register("q_source_filter", V.with_ctes(V.SQL_EV_FILES, SQL_RUN, SQL_LEDGER_OLD, V.SQL_MAIL_LIST, SQL_ACTIVE, SQL_LISTING,
                                         body="SELECT event_id, gmail_id, sender_domain FROM listing"))
def q_source_filter(spark, d):
    """Sender-domain and since-date predicate over the message listing."""
    m, _ = _listing(spark, d)
    return m.select("event_id", "gmail_id", "sender_domain")


SQL_UNSEEN = SQL_PDIM + ",\n" + SQL_DMAP + """,
pm AS (SELECT DISTINCT sender_domain FROM listing),
""" + SQL_SUFFIXES + ",\n" + SQL_EXPECTED + """,
unseen AS (
  SELECT l.event_id, l.gmail_id, l.message_id,
         CASE WHEN l.gmail_id IN (SELECT gmail_id FROM ledger_old WHERE gmail_id IS NOT NULL) THEN 'known_source_id'
              WHEN l.message_id IS NULL THEN 'no_message_id'
              WHEN l.message_id IN (SELECT message_id FROM ledger_old) THEN 'known_message_id'
              WHEN e.expected_folder IS NULL THEN 'unknown_domain' END AS skip_reason
  FROM listing l LEFT JOIN expf e USING (sender_domain))"""


def _unseen(spark, d):
    """Drop known source ids, then known Message-IDs, then unroutable senders."""
    m, old = _listing(spark, d)
    judged = FE.skip_reasons(m, old, dims.domain_folder_map(_pdim(spark)))
    return judged.select("event_id", "gmail_id", "message_id", "skip_reason")


@register("q_unseen_anti", V.with_ctes(V.SQL_EV_FILES, SQL_RUN, SQL_LEDGER_OLD, V.SQL_MAIL_LIST, SQL_ACTIVE, SQL_LISTING, SQL_UNSEEN,
                                       body="SELECT event_id, gmail_id, message_id, skip_reason FROM unseen"))
def q_unseen_anti(spark, d):
    """Listing rows with the reason they are skipped (NULL = new)."""
    return _unseen(spark, d)


@register("q_fetch_summary", V.with_ctes(V.SQL_EV_FILES, SQL_RUN, SQL_LEDGER_OLD, V.SQL_MAIL_LIST, SQL_ACTIVE, SQL_LISTING, SQL_UNSEEN, body="""
SELECT count(*) AS n_found, count(*) FILTER (WHERE skip_reason IS DISTINCT FROM 'known_source_id') AS n_new,
       count(*) FILTER (WHERE skip_reason IS NULL) AS n_downloaded FROM unseen"""))
def q_fetch_summary(spark, d):
    """Found / new / downloaded counts."""
    return FE.summary(_unseen(spark, d))


# ---------------------------------------------------------------- flagship (entry)

def page_offers_raw(spark, d):
    """Links of routed pages as raw offers: X13 -> R1/J2 -> T3 -> X11."""
    links = V.page_links(spark, d)
    mails = R.with_sender_domain(V.page_mails(spark, d).select("page_id", "from_hdr"), "from_hdr")
    routed = R.dispatch(R.detect_provider(mails, _pdim(spark)), CORPUS_EXTRACTABLE)
    to_extract = routed.where(F.col("dispatch_status").isNull()).select("page_id", "provider_key", "sender_domain")
    j = links.join(to_extract, "page_id")
    nid = F.regexp_extract("href", NATIVE_ID_RE, 1)
    prefix = F.concat(F.lit("https://"), F.regexp_extract("url", HOST_RE, 1), F.lit("/view/"))
    url, quality = L.url_quality(nid, prefix, F.col("href"))
    return j.select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("message_id"),
        F.col("pos").alias("offer_pos"), "provider_key", F.lit("").alias("date_email"),
        F.trim(T.clean_entities(F.col("anchor_text"))).alias("titre"),
        F.col("sender_domain").alias("entreprise"),
        *[F.lit("").alias(c) for c in ["ville", "dept", "type_contrat", "salaire_min", "salaire_max", "notes"]],
        url.alias("url"), quality.alias("url_qualite"))


SQL_FLAGSHIP = V.with_ctes(V.SQL_PAGE_LINKS, SQL_PDIM, SQL_PAGE_DOMAINS, SQL_SUFFIXES, SQL_PROVIDER, f"""to_ext AS (
  SELECT pm.page_id, pm.sender_domain, p.provider_key FROM pm JOIN prov p USING (sender_domain)
  WHERE NOT p.skip AND list_contains([{', '.join(sqlx.q(k) for k in CORPUS_EXTRACTABLE)}], p.provider_key)),
page_raw AS (
  SELECT 'p' || l.page_id::VARCHAR AS message_id, l.pos AS offer_pos, t.provider_key, '' AS date_email,
         trim({sqlx.clean_entities('l.anchor_text')}, ' ') AS titre, t.sender_domain AS entreprise, '' AS ville, '' AS notes,
         CASE WHEN regexp_extract(l.href, '{NATIVE_ID_RE}', 1) <> ''
              THEN 'https://' || regexp_extract(l.url, '{HOST_RE}', 1) || '/view/' || regexp_extract(l.href, '{NATIVE_ID_RE}', 1)
              WHEN l.href <> '' THEN {sqlx.clean_entities('l.href')} ELSE '' END AS url,
         CASE WHEN regexp_extract(l.href, '{NATIVE_ID_RE}', 1) <> '' THEN 'construite'
              WHEN l.href <> '' THEN 'email' ELSE 'vide' END AS url_qualite
  FROM page_links l JOIN to_ext t USING (page_id)),
""" + sql_offer_rows("page_raw", "page"), body=f"SELECT {OFFER_COLS_SQL} FROM page_rows")


@register("q_flagship", SQL_FLAGSHIP)
def q_flagship(spark, d):
    """Pages -> links -> provider routing -> cleaning -> ordered IDs ->
    duplicate links -> 21-column offer rows."""
    raw = page_offers_raw(spark, d)
    return EN.offer_rows(raw, keywords=CORPUS_STACK, blacklist=CORPUS_BLACKLIST).drop("_seq")


# The extraction jobs' queries register themselves.
from alertlake.plans import templates as _templates  # noqa: E402,F401
